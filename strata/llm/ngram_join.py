"""N-gram Jaccard join (operator 12): prefix filtering under several global token orders.

A document's set are its distinct shingles of 4 words.  Two sets of similarity t share at least
ceil(t n) elements, n the size of either, so under *any* order of all shingles the
first n - ceil(t n) + 1 elements of both, their prefixes, share an element.  Three orders are used: A, by hash;
C, by another hash; B, rarest first.

1. Blocks count document frequencies (``frequencies``).  An element of one document alone is in no intersection, so it counts as
   missing: of the others, in any order, only the first n - ceil(t n) + 1 - missing are a prefix.  A document
   without one has no partner.
2. Documents of equal sets are one node.  Nodes meet in the buckets of their B prefixes; buckets of
   the same members are one.  A pair of nodes is a candidate only if its sizes allow t and its
   prefixes overlap under A and under C as well; what passes all filters is verified on the whole sets.
3. First every node is tested against one node only: of the first members of its buckets (those with
   the fewest missing elements) the best one.  That turns a big family into one component with one pair for
   each member.  Then members of a bucket outside of its main component are compared with
   its members of other components, chunk by chunk: sizes and 512-bit parity maps of the sets
   (two maps differ in at most as many bits as the sets in elements) leave the pairs that can reach t, the closest few
   of each member go first, until no untested pair is left between two components.

So a link may go untested only within a component.  All of that is exact: no pair is lost.  Shingles are told
apart by 64-bit hashes, sets by 128 bits of those.

Defined results: a text of fewer words, but not none, is one shingle; null texts and those without words have
an empty set and no link, not even with each other; component_id is the smallest doc_id of the component,
null ids aside (null if there is no other; for an empty set its own doc_id); rows that repeat doc_id or text are documents each; an empty
table gives no rows; further columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.blocks import HASHES, Block, Words, buckets_for, is_in, make_blocks
from strata.llm.frequencies import FREQUENCIES, codes_for, counted_rows, frequencies
from strata.llm.graph import joined, settle
from strata.llm.tables import id_text
from strata.llm.token_store import mix
from strata.session import materialize

SHINGLE = 4
PERCENT = 85
FIRST_BEST = 4
CHUNK_OTHERS, CHUNK_ALL = 256, 2048
MAP_BITS = 512
#: Blanks are the bytes 9 to 13 and 32; A-Z fold to a-z.
IS_WORD = np.array([not (b == 32 or 9 <= b <= 13) for b in range(256)])
FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
DOCS = ("doc_id long, n long, node binary, missing long, prefix array<long>, under_a array<int>, under_c array<int>, "
        "map binary, rest binary")
MEMBER = np.dtype([("node", "S16"), ("label", "S16"), ("n", "<i8"), ("map", "u1", (MAP_BITS // 8,))])


# -------------------------------------------------------------------- sets
def shingle_sets(texts: list[bytes], k: int = SHINGLE) -> list[np.ndarray]:
    """The ascending distinct shingle hashes of every text."""
    words = Words(texts, IS_WORD, FOLD)
    at, h = words.windows(k)
    first = np.searchsorted(words.doc[at], np.arange(len(texts) + 1))
    n = np.diff(words.first)
    out = []
    for d in range(len(texts)):
        if 0 < n[d] < k:
            own = words.hash[words.first[d]:words.first[d + 1]]
            x = np.zeros(1, np.uint64)
            for w in own:
                x = mix(x ^ w, 61)
            out.append(mix(x, 62))
        else:
            out.append(np.unique(h[first[d]:first[d + 1]]))
    return out


def least_shared(n, percent: int = PERCENT):
    """Elements that a set of n shares at least with any partner."""
    return (percent * n + 99) // 100


def order_c(h: np.ndarray) -> np.ndarray:
    return mix(h, 63)


def _by_set(texts: list[bytes]) -> tuple[list[np.ndarray], list[bytes], np.ndarray]:
    """Sets, their names, and which texts are the first of their set in the block."""
    sets = shingle_sets(texts)
    names = [hashlib.md5(s.tobytes()).digest() if len(s) else b"" for s in sets]
    seen: set[bytes] = set()
    first = np.array([bool(x) and not (x in seen or seen.add(x)) for x in names], bool)
    return sets, names, first


def _known(sets: list[np.ndarray], first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of a block's sets, and how many of them have each."""
    parts = [s for s, f in zip(sets, first) if f]
    return np.unique(np.concatenate(parts), return_counts=True) if parts else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _emit(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        block = Block(t)
        sets, _, first = _by_set(block.texts)
        return counted_rows(block, *_known(sets, first), buckets)
    return run


def parity_map(s: np.ndarray, bits: int = MAP_BITS) -> bytes:
    """One bit for each of ``bits`` classes of elements: is their number odd?"""
    return np.packbits(np.bincount((mix(s, 64) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1).tobytes()


def _nodes(buckets: int, percent: int):
    """A row for every document; the first of a set that may have a partner holds what the join needs."""
    schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.binary()), ("missing", pa.int64()),
                        ("prefix", pa.list_(pa.int64())), ("under_a", pa.list_(pa.int32())), ("under_c", pa.list_(pa.int32())),
                        ("map", pa.binary()), ("rest", pa.binary())])

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        block = Block(docs)
        sets, names, first = _by_set(block.texts)
        known, _ = _known(sets, first)
        codes = codes_for(known, buckets, told)
        rows = []
        for s, name, f in zip(sets, names, first):
            extra = None
            if f:
                often = codes[np.searchsorted(known, s)]
                rest, often = s[often > 0], often[often > 0]
                p = len(s) - int(least_shared(len(s), percent)) + 1 - (len(s) - len(rest))
                if p > 0:
                    b = rest[np.lexsort((rest, often))[:p]]
                    c = order_c(rest)
                    c = c[np.argpartition(c, p - 1)[:p]] if p < len(c) else c
                    # 32 bits of the order's hashes: unequal elements may look equal, which only costs a test
                    extra = (len(s) - len(rest), b.view(np.int64), (rest[:p] >> np.uint64(32)).astype(np.uint32).view(np.int32),
                             (c >> np.uint64(32)).astype(np.uint32).view(np.int32), parity_map(s), rest.tobytes())
            rows.append((len(s), name or None, *(extra or (None,) * 6)))
        cols = list(zip(*rows)) if rows else [[]] * 8
        return pa.table([block.doc_id, *[pa.array(list(c), f.type) for c, f in zip(cols, list(schema)[1:])]], schema=schema)
    return run


# -------------------------------------------------------------------- join
def sizes_allow(a: Column, b: Column, percent: int) -> Column:
    return F.least(a, b) * 100 >= F.greatest(a, b) * percent


def _verify(percent: int):
    def run(batches):
        for b in batches:
            ok = []
            for x, y, n, m in zip(b.column("ra"), b.column("rb"), b.column("na").to_pylist(), b.column("nb").to_pylist()):
                x, y = np.frombuffer(x.as_buffer(), "<u8"), np.frombuffer(y.as_buffer(), "<u8")
                both = int(is_in(x, y).sum())
                ok.append(100 * both >= percent * (n + m - both))
            yield pa.record_batch({"a": b.column("a"), "b": b.column("b"), "ok": pa.array(ok, pa.bool_())})
    return run


def _linked(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar enough: first the prefixes under A and C, then whole sets."""
    def with_both(df: DataFrame, *cols: str) -> DataFrame:
        for side in "ab":
            df = df.join(nodes.select(F.col("node").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in cols]), side)
        return df

    near = with_both(pairs, "n", "under_a", "under_c").filter(
        sizes_allow(F.col("n_a"), F.col("n_b"), percent)
        & F.arrays_overlap("under_a_a", "under_a_b") & F.arrays_overlap("under_c_a", "under_c_b")).select("a", "b")
    sets = with_both(near, "n", "rest").select("a", "b", F.col("n_a").alias("na"), F.col("n_b").alias("nb"),
                                               F.col("rest_a").alias("ra"), F.col("rest_b").alias("rb"))
    return materialize(sets.mapInArrow(_verify(percent), "a binary, b binary, ok boolean").filter("ok").select("a", "b"), "ngram-links")


def _to_chunk(t: pa.Table) -> pa.Table:
    t = t.sort_by("node")
    out = np.empty(t.num_rows, MEMBER)
    out["node"], out["label"], out["n"] = t.column("node").to_pylist(), t.column("label").to_pylist(), t.column("n").to_numpy()
    out["map"] = np.frombuffer(b"".join(t.column("map").to_pylist()), np.uint8).reshape(-1, MAP_BITS // 8)
    return pa.table({"token": t.column("token").slice(0, 1), "members": pa.array([out.tobytes()], pa.binary())})


def _full(x: np.ndarray) -> list[bytes]:
    """Names of 16 bytes (numpy cuts zeros at the end)."""
    return [v.ljust(16, b"\0") for v in x.tolist()]


def _candidates(percent: int, best: int, seen: int):
    """Pairs of members of two chunks that can reach the similarity and lie in two components: those of the
    ranks from ``seen`` to ``best`` of each member of the first chunk, and one row without a partner where such
    pairs of higher ranks remain."""
    def run(batches):
        for batch in batches:
            a, b = [], []
            for x, y in zip(batch.column("others").to_pylist(), batch.column("members").to_pylist()):
                x, y = np.frombuffer(x, MEMBER), np.frombuffer(y, MEMBER)
                names = _full(y["node"])
                for member, name in zip(x, _full(x["node"])):
                    differ = np.bitwise_count(member["map"][None] ^ y["map"]).sum(1, dtype=np.int64)
                    n, both = int(member["n"]), int(member["n"]) + y["n"]
                    # at most (both - differ) / 2 elements in common
                    near = (100 * (both - differ) >= percent * (both + differ)) & (100 * np.minimum(n, y["n"]) >= percent * np.maximum(n, y["n"]))
                    near = np.flatnonzero(near & (y["node"] != member["node"]))
                    near = near[np.argsort(differ[near], kind="stable")]
                    other = y["label"][near] != member["label"]
                    pick = near[seen:best][other[seen:best]]
                    a += [name] * len(pick)
                    b += [names[i] for i in pick]
                    if other[best:].any():
                        a.append(name)
                        b.append(None)
            yield pa.record_batch({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})
    return run


def _labels(nodes: DataFrame, percent: int) -> DataFrame:
    """(node, label) of the nodes that share a bucket."""
    posting = nodes.select("node", "n", "missing", F.explode("prefix").alias("token"))
    first = F.min(F.struct("missing", "node")).alias("_first")
    buckets = posting.groupBy("token").agg(
        F.count(F.lit(1)).alias("_n"), F.bit_xor(F.xxhash64("node")).alias("_x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_y"), first)
    # buckets of equal members are one
    buckets = buckets.filter("_n > 1").groupBy("_n", "_x", "_y").agg(F.min("token").alias("token"), F.first("_first").alias("_first"))
    members = materialize(posting.join(buckets.select("token", "_n", "_first"), "token"), "ngram-members")
    lead = (members.filter((F.col("node") != F.col("_first.node"))).groupBy("node").agg(F.min("_first").alias("_best")))
    links = _linked(lead.select(F.col("node").alias("a"), F.col("_best.node").alias("b")), nodes, percent)
    own = members.select("node").distinct()
    label = settle(own.join(links.select(F.col("a").alias("node"), F.col("b").alias("label")), "node", "left")
                   .select("node", F.coalesce("label", "node").alias("label")), "ngram-labels")
    seen, best = 0, FIRST_BEST
    while True:
        now = members.join(label, "node")
        # the main component of a bucket is that of its first member
        state = now.groupBy("token").agg(F.min_by("label", F.struct("missing", "node")).alias("_main"),
                                         F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo != _hi")
        now = now.join(state.select("token", "_main"), "token").join(nodes.select("node", "map"), "node")
        now = materialize(now.select("token", "node", "label", "n", "map", "_n", "_main"), "ngram-open")
        other = now.filter("label != _main")
        other = other.join(other.groupBy("token").agg(F.count(F.lit(1)).alias("_m")), "token")

        def chunks(df: DataFrame, count: str, size: int, name: str) -> DataFrame:
            part = F.pmod(F.xxhash64("node"), F.ceil(F.col(count) / size)).alias("_chunk")
            return df.select("token", part, "node", "label", "n", "map").groupBy("token", "_chunk").applyInArrow(
                _to_chunk, "token long, members binary").withColumnRenamed("members", name)

        met = chunks(other, "_m", CHUNK_OTHERS, "others").join(chunks(now, "_n", CHUNK_ALL, "members"), "token")
        found = materialize(met.select("others", "members").mapInArrow(_candidates(percent, best, seen), "a binary, b binary"), "ngram-pairs")
        pairs = found.filter(F.col("b").isNotNull()).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        if not pairs.isEmpty():
            links = _linked(pairs, nodes, percent)
            if not links.isEmpty():
                label = joined(label, links, "ngram-labels")
        if found.filter(F.col("b").isNull()).isEmpty():
            return label
        seen, best = best, best * 8


def jaccard_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """Per document row: doc_id, n_shingles, set_md5 (of its shingle hashes), component_id and
    component_size (rows)."""
    rows = id_text(docs, doc_id, text)
    blocks, total = make_blocks(rows)
    buckets = buckets_for(total / 5)
    of_block = blocks.groupBy("block")
    told = of_block.applyInArrow(_emit(buckets), HASHES).groupBy("bucket").applyInArrow(frequencies, FREQUENCIES)
    made = materialize(of_block.cogroup(told.groupBy("block")).applyInArrow(_nodes(buckets, percent), DOCS), "ngram-documents")
    blocks.unpersist()
    nodes = materialize(made.filter(F.col("rest").isNotNull()).drop("doc_id").dropDuplicates(["node"]), "ngram-nodes")
    label = _labels(nodes, percent)
    keyed = made.select("doc_id", "n", "node").join(label, "node", "left").select(
        "doc_id", "n", "node", F.coalesce("label", "node").alias("_key"))
    classes = keyed.filter(F.col("_key").isNotNull()).groupBy("_key").agg(
        F.min("doc_id").alias("component_id"), F.count(F.lit(1)).alias("component_size"))
    alone = F.col("_key").isNull()
    return keyed.join(classes, "_key", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.lower(F.hex("node")).alias("set_md5"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("component_size")).cast("long").alias("component_size"))
