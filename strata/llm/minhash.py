"""MinHash near-dedup (operator 1): improved consistent weighted sampling over
TF-IDF shingles, banded, verified by weighted Jaccard similarity.

Shingles are 5 consecutive words (runs of digits, letters and all that is not
ASCII, A-Z lower-cased); a text of fewer words, but not none, is one shingle.  The
weight of a shingle is its count times idf = 0.9 + 0.1 ln(N / df) / ln(N): 1 for what one of the N documents has, 0.9 for
what all have.  (A steeper idf would push copies of a popular text apart: their shared shingles
would weigh less than the few words in which they differ.  With this floor, a pair of one family of any share of
the documents that has a plain similarity of s gets 0.9 s / (1 - 0.1 s) at least: 0.8 from s = 0.817 on.)

1. Blocks count document frequencies: distinct shingle hashes go to hash
   buckets, and each block hears the frequencies of those that other documents have too.
2. A shingle of one document alone matches nothing, so the share of a
   document's weight on shared shingles bounds its similarity to any other;
   documents under the threshold have no partner and go no further (this loses
   no pair).
3. The others get 64 samples (16 bands of 4) and one row per distinct text.
4. The leaders of a band bucket are the two members with the least weight on unshared shingles (the text
   the others were made from comes first).  Every node is tested against one of the leaders of its buckets only, the one it
   meets most often, by weighted Jaccard similarity of their whole shingle vectors.  That makes a family of any size
   one component with one pair for each member.  Members of a
   bucket that are not in its main component are then compared with all its members of other
   components, chunk by chunk: the weights give an upper bound, the samples an
   estimate of the similarity, and pairs with a bound of 0.8 and an estimate of 0.62 or more
   are verified, the best few of each member first, as long as they would join two components.  Pairs that could not change a class are left out.
5. Classes are the connected components of the links (``graph``), kept as tables in the checkpoint folder.

A pair of similarity 0.8 shares a band with probability 0.9998, and its estimate
is under 0.62 with probability 0.0003.  Equal texts need no link: they are one node.

Defined results: null and empty texts, and texts without words, are near
duplicates of equal texts only; a class's id is the smallest doc_id in it (null
if all are null); rows that repeat doc_id or text get their text's class;
an empty table gives no rows; further columns are ignored by ``near_classes`` and kept
by ``near_dedup`` (of rows that repeat doc_id and text, the one whose JSON has the smallest hash).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.blocks import HASHES, Block, Words, buckets_for, make_blocks
from strata.llm.frequencies import FREQUENCIES, codes_for, counted_rows, frequencies, frequency_of
from strata.llm.graph import joined, settle
from strata.llm.tables import id_text, release_driver, trim
from strata.llm.token_store import mix
from strata.session import materialize

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 16, 4
LEADERS = 2
#: standard deviations that an estimate may fall short of the threshold
SLACK = 3.5
FIRST_BEST = 4
CHUNK_OTHERS, CHUNK_ALL = 256, 2048
#: Word bytes are digits, letters and bytes from 128 on; A-Z fold to a-z.
IS_WORD = np.array([48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
FOLD = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
#: idf of a shingle that all documents have
FLOOR = 0.9
SKETCH = "node string, unshared double, weight double, vector binary, bands array<long>, samples binary"


def shingles(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (document, 64-bit shingle hash) pairs in order, and counts."""
    words = Words(texts, IS_WORD, FOLD)
    at, h = words.windows(k)
    doc = words.doc[at]
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < k))
    if len(short):
        whole = np.array([mix(np.array([sum(int(x) * pow(0xD1342543DE82EF95, j, 1 << 64) for j, x in enumerate(
            words.hash[words.first[d]:words.first[d + 1]])) & (1 << 64) - 1], np.uint64), 24)[0] for d in short], np.uint64)
        doc, h = np.concatenate([doc, short]), np.concatenate([h, whole])
    order = np.lexsort((h, doc))
    doc, h = doc[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (h[1:] != h[:-1])
    first = np.flatnonzero(new)
    return doc[first], h[first], np.diff(np.append(first, len(h)))


def _emit(buckets: int):
    def run(t: pa.Table) -> pa.Table:
        block = Block(t)
        return counted_rows(block, *np.unique(shingles(block.texts)[1], return_counts=True), buckets)
    return run


def idf(df: np.ndarray, rows: int) -> np.ndarray:
    """From 1 (one document) to ``FLOOR`` (all of them); frequencies come in steps of a twelfth of a doubling."""
    return FLOOR + (1 - FLOOR) * np.log(rows / df) / np.log(rows) if rows > 1 else np.ones(len(df))


# --------------------------------------------------------------- sampling
def uniform(h: np.ndarray, seed: int) -> np.ndarray:
    """Hashed numbers in (0, 1)."""
    return ((mix(h, seed) >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53


def consistent_samples(h: np.ndarray, weight: np.ndarray, first: np.ndarray, samples: int) -> np.ndarray:
    """Improved consistent weighted sampling.  The documents' shingles lie one
    after another, ``first`` has where each begins (none is empty); the
    result has ``samples`` hashes (element, level) per document.  Two
    documents agree on each with a probability of their weighted Jaccard similarity."""
    out = np.empty((len(first), samples), np.uint64)
    sizes = np.diff(np.append(first, len(h)))
    doc = np.repeat(np.arange(len(first)), sizes)
    log_w = np.log(weight)
    for k in range(samples):
        r = -np.log(uniform(h, 1000 + 5 * k) * uniform(h, 1001 + 5 * k))  # gamma(2, 1)
        c = -np.log(uniform(h, 1002 + 5 * k) * uniform(h, 1003 + 5 * k))
        beta = uniform(h, 1004 + 5 * k)
        t = np.floor(log_w / r + beta)
        a = np.log(c) - r * (t - beta) - r
        best = np.flatnonzero(a == np.minimum.reduceat(a, first)[doc])
        _, lead = np.unique(doc[best], return_index=True)
        pick = best[lead]
        out[:, k] = mix(h[pick] ^ mix(t[pick].astype(np.int64).view(np.uint64), 51), 52)
    return out


VECTOR = np.dtype([("h", "<u8"), ("w", "<f4")])


def weighted_jaccard(a: np.ndarray, b: np.ndarray, wa: float | None = None, wb: float | None = None) -> float:
    """sum of min over sum of max; vectors ascending by hash.  Entries that one document alone has may be left out
    where the vectors' whole weights are given."""
    _, i, j = np.intersect1d(a["h"], b["h"], assume_unique=True, return_indices=True)
    low = np.minimum(a["w"][i], b["w"][j]).sum(dtype=np.float64)
    wa = a["w"].sum(dtype=np.float64) if wa is None else wa
    total = wa + (b["w"].sum(dtype=np.float64) if wb is None else wb) - low
    return float(low / total) if total else 1.0


def _sketch(rows: int, buckets: int, threshold: float, bands: int, per_band: int):
    schema = pa.schema([("node", pa.string()), ("unshared", pa.float64()), ("weight", pa.float64()), ("vector", pa.binary()), ("bands", pa.list_(pa.int64())), ("samples", pa.binary())])

    def run(docs: pa.Table, told: pa.Table) -> pa.Table:
        import hashlib

        block = Block(docs)
        doc, h, n = shingles(block.texts)
        distinct, place = np.unique(h, return_inverse=True)
        code = codes_for(distinct, buckets, told)[place]
        shared = code > 0
        weight = n * idf(np.minimum(frequency_of(code), rows), rows)
        total = np.bincount(doc, weight, len(block.texts))
        with_others = np.bincount(doc, weight * shared, len(block.texts))
        stay = (total > 0) & (with_others >= (threshold - 1e-6) * total)
        # one of equal texts of the block is enough
        node = {i: hashlib.md5(block.texts[i]).hexdigest() for i in np.flatnonzero(stay).tolist()}
        seen: set[str] = set()
        for i, m in node.items():
            stay[i] = m not in seen
            seen.add(m)
        keep = stay[doc]
        doc, h, weight = doc[keep], h[keep], weight[keep]
        ids = np.flatnonzero(stay)
        if not len(ids):
            return schema.empty_table()
        first = np.searchsorted(doc, ids)
        sample = consistent_samples(h, weight, first, bands * per_band).reshape(len(ids), bands, per_band)
        key = np.zeros((len(ids), bands), np.uint64)
        for r in range(per_band):
            key = mix(key ^ sample[:, :, r], 53)
        # only what others have can be in an intersection
        held = np.flatnonzero(shared[keep])
        vector = np.empty(len(held), VECTOR)
        vector["h"], vector["w"] = h[held], weight[held]
        first = np.searchsorted(doc[held], ids)
        last = np.append(first[1:], len(held))
        return pa.table({"node": pa.array([node[i] for i in ids.tolist()]), "unshared": pa.array(1 - with_others[ids] / total[ids]),
                         "weight": pa.array(total[ids]),
                         "vector": pa.array([vector[a:b].tobytes() for a, b in zip(first, last)], pa.binary()),
                         "bands": pa.array(key.view(np.int64).tolist(), pa.list_(pa.int64())),
                         "samples": pa.array([x.astype("<u2").tobytes() for x in sample], pa.binary())}, schema)
    return run


def _similar(threshold: float):
    def run(batches):
        for b in batches:
            four = zip(*(b.column(c).to_pylist() for c in ("va", "vb", "wa", "wb")))
            s = [weighted_jaccard(np.frombuffer(x, VECTOR), np.frombuffer(y, VECTOR), wx, wy) for x, y, wx, wy in four]
            yield pa.record_batch({"a": b.column("a"), "b": b.column("b"), "ok": pa.array([v >= threshold - 1e-6 for v in s])})
        trim()
    return run


def _entry(samples: int) -> np.dtype:
    return np.dtype([("node", "S32"), ("label", "S32"), ("u", "<f8"), ("w", "<f8"), ("samples", "<u2", (samples,))])


def most_similar(ua, wa, ub, wb, least, greatest):
    """Upper bound of the weighted Jaccard similarity of two vectors of weight
    wa and wb, of which the shares ua and ub are on shingles of no other
    document: those are outside the intersection, and all of them in the union."""
    return least((1 - ua) * wa, (1 - ub) * wb) / greatest(wa + ub * wb, wb + ua * wa)


def _to_chunk(samples: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("node")
        out = np.empty(t.num_rows, _entry(samples))
        out["node"], out["label"] = t.column("node").to_pylist(), t.column("label").to_pylist()
        out["u"], out["w"] = t.column("unshared").to_numpy(), t.column("weight").to_numpy()
        out["samples"] = np.frombuffer(b"".join(t.column("samples").to_pylist()), "<u2").reshape(-1, samples)
        return pa.table({"band": t.column("band").slice(0, 1), "key": t.column("key").slice(0, 1),
                         "members": pa.array([out.tobytes()], pa.binary())})
    return run


def _candidates(bands: int, per_band: int, threshold: float, floor: float, best: int, seen: int):
    """Pairs of two chunks of a bucket whose samples agree often enough, whose weights
    allow the threshold, that share no earlier band and whose components differ: those of the ranks from ``seen``
    to ``best`` for each member of the first chunk, and one row without a
    partner where such pairs of higher ranks remain."""
    dtype = _entry(bands * per_band)

    def run(batches):
        for batch in batches:
            for band, x, y in zip(batch.column("band").to_pylist(), batch.column("others").to_pylist(), batch.column("members").to_pylist()):
                x, y = np.frombuffer(x, dtype), np.frombuffer(y, dtype)
                a, b = [], []
                for lo in range(0, len(x), 16):
                    part = x[lo:lo + 16]
                    equal = part["samples"][:, None, :] == y["samples"][None, :, :]
                    good = equal.mean(2) * (part["node"][:, None] != y["node"][None, :])
                    most = most_similar(part["u"][:, None], part["w"][:, None], y["u"], y["w"], np.minimum, np.maximum)
                    good[most < threshold - 1e-6] = 0
                    if band:
                        good[equal.reshape(len(part), len(y), bands, per_band)[:, :, :band].all(3).any(2)] = 0
                    for i in range(len(part)):
                        near = np.flatnonzero(good[i] >= floor)
                        near = near[np.argsort(-good[i][near], kind="stable")]
                        differs = part["label"][i] != y["label"][near]
                        pick = near[seen:best][differs[seen:best]]
                        node = part["node"][i].decode()
                        a += [node] * len(pick)
                        b += [v.decode() for v in y["node"][pick]]
                        if differs[best:].any():
                            a.append(node)
                            b.append(None)
                yield pa.record_batch({"a": pa.array(a, pa.string()), "b": pa.array(b, pa.string())})
        trim()
    return run


def _verified(pairs: DataFrame, vectors: DataFrame, threshold: float) -> DataFrame:
    """The pairs that are similar enough.  Copies of one member's vector meet its
    partners in joins that Spark splits."""
    both = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    tested = (
        both.join(vectors.select(F.col("node").alias("a"), F.col("vector").alias("va"), F.col("weight").alias("wa")), "a")
        .join(vectors.select(F.col("node").alias("b"), F.col("vector").alias("vb"), F.col("weight").alias("wb")), "b")
        .select("a", "b", "va", "vb", "wa", "wb").mapInArrow(_similar(threshold), "a string, b string, ok boolean")
    )
    return materialize(tested.filter("ok").select("a", "b"), "near-verified")


def best_leaders(member: DataFrame, threshold: float) -> DataFrame:
    """(a, b): for every node a the leader b of its buckets that it meets most often.  A leader
    comes before the node in the order of (unshared, node), so the pairs form a forest."""
    bucket = ["band", "key"]
    order = Window.partitionBy(*bucket).orderBy("unshared", "node")
    lead = (member.withColumn("_r", F.row_number().over(order)).filter(F.col("_r") <= LEADERS)
            .select(*bucket, F.col("node").alias("b"), F.col("unshared").alias("ub"), F.col("weight").alias("wb")))
    own = member.select(*bucket, F.col("node").alias("a"), F.col("unshared").alias("ua"), F.col("weight").alias("wa"))
    most = most_similar(*map(F.col, ("ua", "wa", "ub", "wb")), F.least, F.greatest)
    met = own.join(lead, bucket).filter((F.struct("ub", "b") < F.struct("ua", "a")) & (most >= threshold - 1e-6))
    often = met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("_n"), F.first("ub").alias("ub"))
    return often.groupBy("a").agg(F.max(F.struct("_n", -F.col("ub"), "b")).alias("_best")).select("a", F.col("_best.b").alias("b"))


def near_links(sketches: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS,
               per_band: int = ROWS) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) between nodes that share a band bucket, as many as it
    takes to connect every pair of a bucket that is similar enough, and the
    components (node, label) of the nodes that share a bucket."""
    vectors = sketches.select("node", "vector", "weight")
    member = sketches.select("node", "unshared", "weight", F.posexplode("bands").alias("band", "key"))
    bucket = ["band", "key"]
    often = member.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    member = materialize(member.join(often, bucket), "near-members")
    links = _verified(best_leaders(member, threshold), vectors, threshold)
    # the later of two nodes in the order of the leaders has the other for its parent
    place = sketches.select("node", F.struct("unshared", "node").alias("_o"))
    ends = (links.join(place.select(F.col("node").alias("a"), F.col("_o").alias("_a")), "a")
            .join(place.select(F.col("node").alias("b"), F.col("_o").alias("_b")), "b"))
    parent = ends.select(F.greatest("_a", "_b")["node"].alias("node"), F.least("_a", "_b")["node"].alias("label"))
    label = settle(member.select("node").distinct().join(parent, "node", "left").select(
        "node", F.coalesce("label", "node").alias("label")), "near-labels")
    samples = bands * per_band
    floor = threshold - SLACK * (threshold * (1 - threshold) / samples) ** 0.5
    seen, best = 0, FIRST_BEST
    now = left = None
    while True:
        release_driver(sketches.sparkSession)
        if now is None:
            now = open_buckets(member, label, sketches)
        # labels only merge, and a bucket's chunks stay: a member without pairs of higher ranks gets none later
        other = now.filter(F.col("label") != F.col("_main"))
        if left is not None:
            other = other.join(left, "node", "left_semi")
        held = other.groupBy(*bucket).agg(F.count(F.lit(1)).alias("_m"))
        other = other.join(held, bucket)
        near = now if left is None else now.join(held.select(*bucket), bucket, "left_semi")

        def chunks(df: DataFrame, n: str, size: int, name: str) -> DataFrame:
            part = F.pmod(F.xxhash64("node"), F.ceil(F.col(n) / size)).alias("_chunk")
            return df.select(*bucket, part, "node", "label", "unshared", "weight", "samples").groupBy(*bucket, "_chunk").applyInArrow(
                _to_chunk(samples), "band int, key long, members binary").withColumnRenamed("members", name)

        met = chunks(other, "_m", CHUNK_OTHERS, "others").join(chunks(near, "_n", CHUNK_ALL, "members"), bucket)
        found = materialize(met.select("band", "others", "members").mapInArrow(
            _candidates(bands, per_band, threshold, floor, best, seen), "a string, b string"), "near-candidates")
        pairs = found.filter(F.col("b").isNotNull())
        more = None if pairs.isEmpty() else _verified(pairs, vectors, threshold)
        if more is not None and not more.isEmpty():
            links = materialize(links.unionByName(more).distinct(), "near-links")
            label = joined(label, more, "near-labels")
            now = None
        left = found.filter(F.col("b").isNull()).select(F.col("a").alias("node")).distinct()
        if left.isEmpty():
            return links, label
        seen, best = best, best * 8


def open_buckets(member: DataFrame, label: DataFrame, sketches: DataFrame) -> DataFrame:
    """The members, with their samples, of buckets that hold several components.  The main one of a bucket is that of its first leader."""
    bucket = ["band", "key"]
    now = member.join(label, "node")
    state = now.groupBy(*bucket).agg(F.min_by("label", F.struct("unshared", "node")).alias("_main"),
                                     F.min("label").alias("_lo"), F.max("label").alias("_hi")).filter("_lo != _hi")
    now = now.join(state.select(*bucket, "_main"), bucket).join(sketches.select("node", "samples"), "node")
    return materialize(now, "near-open")


def text_classes(rows: DataFrame, threshold: float, bands: int, per_band: int) -> DataFrame:
    """One row per distinct text: node (md5), first_id, copies, label, n_links."""
    blocks, total = make_blocks(rows)
    n = rows.count()
    buckets = buckets_for(total / 6)
    hashes = blocks.groupBy("block").applyInArrow(_emit(buckets), HASHES)
    told = hashes.groupBy("bucket").applyInArrow(frequencies, FREQUENCIES)
    made = materialize(blocks.groupBy("block").cogroup(told.groupBy("block"))
                       .applyInArrow(_sketch(n, buckets, threshold, bands, per_band), SKETCH), "near-sketches")
    blocks.unpersist()
    release_driver(rows.sparkSession)
    # equal texts of several blocks: any of the equal rows
    sketches = materialize(made.dropDuplicates(["node"]), "near-nodes")
    links, label = near_links(sketches, threshold, bands, per_band)
    release_driver(rows.sparkSession)
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    labels = label.join(degree, "node", "left")
    return (
        rows.groupBy(text_node().alias("node")).agg(F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("copies"))
        .join(labels, "node", "left")
        .select("node", "first_id", "copies", F.coalesce("label", "node").alias("label"),
                F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
    )


def text_node(text: str = "text"):
    return F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))


def near_classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                 bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """Per document row: doc_id, text_md5, class_id (smallest doc_id of its class),
    class_size (rows), n_links (verified links of its text: its leader, those it leads, and pairs
    that joined components; similar texts of one component that were not compared are not in it)."""
    rows = id_text(docs, doc_id, text)
    texts = materialize(text_classes(rows, threshold, bands, per_band), "near-classes")
    classes = texts.groupBy("label").agg(F.min("first_id").alias("class_id"), F.sum("copies").alias("class_size"))
    of_text = texts.select("node", "label", "n_links").join(classes, "label")
    return rows.select("doc_id", text_node().alias("node")).join(of_text, "node").select(
        "doc_id", F.col("node").alias("text_md5"), "class_id", "class_size", "n_links")


def near_dedup(docs: DataFrame, threshold: float = THRESHOLD, bands: int = BANDS, per_band: int = ROWS) -> DataFrame:
    """One row of each class, the one of the smallest doc_id, with all its columns."""
    texts = materialize(text_classes(id_text(docs), threshold, bands, per_band), "near-classes")
    best = texts.groupBy("label").agg(F.min(F.struct(F.isnull("first_id").alias("a"), "first_id", "node")).alias("_b"))
    best = best.select(F.col("_b.node").alias("_node"), F.col("_b.first_id").alias("_id"))
    keyed = docs.select(F.struct(*docs.columns).alias("_row"), text_node().alias("_node"))
    stay = keyed.join(best, "_node").filter(F.col("_row.doc_id").eqNullSafe(F.col("_id")))
    # one row per text, but for rows that repeat doc_id and text: of those the same one in every attempt
    return stay.groupBy("_node").agg(F.min_by("_row", F.xxhash64(F.to_json("_row"))).alias("_row")).select("_row.*")
