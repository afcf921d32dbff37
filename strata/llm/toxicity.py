"""Toxicity (operator 8): a factorization machine over hashed terms.

score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2))

The pairwise part learns interactions of terms (an insult and the mention of a
group) that additive weights miss.  x: the distinct hashed terms of the whole
text (lower-cased runs of letters, and the first four letters of longer ones),
weighted 1.  Before fitting, terms are screened: those in fewer than 4 sampled
rows, or whose chi-square with the label is under 10, get no weights.

The machine is fitted on the driver, on a bounded sample of labelled rows:
``max_rows`` (24,000 by default) rows with the smallest hashes of their ids,
half of them for either label where there are enough, and of the rows of one id
the one whose text has the smallest hash.  Terms are hashed in the
tasks into ``2 ** bits`` slots, and a text brings at most its distinct slots.
The weights (a fixed 2 ** bits x (1 + factors) floats) are the only thing sent to
the tasks.  Sampling by label shifts the prior; the intercept is moved
back by the logit of the true share, counted over all training rows.

Scoring reads every whole text, in one pass without a shuffle.

Defined results: null or empty texts have no terms and score the intercept;
null labels are no labels; a doc_id labelled more than once counts as toxic if
any of its labels is 1; rows of a null doc_id have no label, are not held out and are scored
like others; an unlabelled corpus (or one with a single class) scores the
share of toxic rows (0 without labels); empty tables give no rows.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.tables import release_driver, ship_package

BITS = 18
FACTORS = 4
MAX_ROWS = 24_000
EPOCHS = 10
#: small samples are passed over more often, to at least so many steps
MIN_STEPS = 300
MIN_ROWS, MIN_CHI2 = 4, 10.0
THRESHOLD = 0.3
TERM = re.compile(r"[^\W\d_]+")


def slots_of(text: str | None, bits: int) -> np.ndarray:
    """Distinct hashed slots of a whole text: its terms and their 4-letter beginnings."""
    terms = set(TERM.findall(text.lower())) if text else set()
    terms |= {"^" + t[:4] for t in terms if len(t) > 4}
    mask = (1 << bits) - 1
    return np.unique(np.fromiter((zlib.crc32(t.encode()) * 0x9E3779B1 >> 7 & mask for t in terms), np.int32, len(terms)))


def _slot_batches(bits: int):
    def run(batches):
        for b in batches:
            for a in range(0, b.num_rows, 256):
                texts = b.column("text").slice(a, 256).to_pylist()
                yield pa.record_batch({
                    "label": b.column("label").slice(a, 256),
                    "slots": pa.array([slots_of(t, bits).astype("<i4").tobytes() for t in texts], pa.binary())})
    return run


def screen(rows: list[np.ndarray], y: np.ndarray, n: int) -> np.ndarray:
    """Slots that tell the two classes of a sample apart."""
    a, b = (np.bincount(np.concatenate([r for r, v in zip(rows, y) if v == c]), minlength=n) for c in (1, 0))
    n1, n0 = y.sum(), (1 - y).sum()
    p = (a + b) / (n1 + n0)
    chi2 = (a / n1 - b / n0) ** 2 / np.maximum(p * (1 - p) * (1 / n1 + 1 / n0), 1e-12)
    return (a + b >= MIN_ROWS) & (chi2 >= MIN_CHI2)


class FactorizationMachine:
    """Second-order machine on sets of slots, trained by mini-batch Adagrad."""

    def __init__(self, bits: int = BITS, factors: int = FACTORS, seed: int = 7):
        self.w0 = 0.0
        self.w = np.zeros(1 << bits, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (1 << bits, factors)).astype(np.float32)

    def raw(self, idx: np.ndarray, row: np.ndarray, n: int):
        """Scores of n rows given as parallel arrays of slot and row number."""
        v = self.v[idx]
        lin = np.bincount(row, self.w[idx], n)
        s = np.stack([np.bincount(row, v[:, f], n) for f in range(v.shape[1])], 1)
        sq = np.bincount(row, np.einsum("ij,ij->i", v, v), n)
        return self.w0 + lin + 0.5 * ((s * s).sum(1) - sq), s, v

    def proba(self, idx, row, n):
        return 1 / (1 + np.exp(-np.clip(self.raw(idx, row, n)[0], -30, 30)))

    def fit(self, rows: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, batch: int = 64,
            rate: float = 0.08, l2: float = 1e-5, seed: int = 7):
        keep = screen(rows, y, len(self.w))
        self.v[~keep] = 0
        rows = [r[keep[r]] for r in rows]
        gw, gv = np.full_like(self.w, 1e-3), np.full_like(self.v, 1e-3)
        g0 = 1e-3
        self.w0 = float(np.log(y.sum() / (1 - y).sum()))  # rows without any telling term
        epochs = max(epochs, -(-MIN_STEPS * batch // max(len(rows), 1)))
        rng = np.random.default_rng(seed)
        for _ in range(epochs):
            order = rng.permutation(len(rows))
            for a in range(0, len(order), batch):
                pick = order[a:a + batch]
                idx = np.concatenate([rows[i] for i in pick])
                row = np.repeat(np.arange(len(pick)), [len(rows[i]) for i in pick])
                z, s, v = self.raw(idx, row, len(pick))
                e = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[pick]) / len(pick)
                g0 += e.sum() ** 2
                self.w0 -= rate * e.sum() / np.sqrt(g0)
                if not len(idx):
                    continue
                slot, at = np.unique(idx, return_inverse=True)
                dw = np.bincount(at, e[row], len(slot)) + l2 * self.w[slot]
                one = e[row, None] * (s[row] - v)
                dv = np.stack([np.bincount(at, one[:, f], len(slot)) for f in range(v.shape[1])], 1) + l2 * self.v[slot]
                gw[slot] += dw * dw
                gv[slot] += dv * dv
                self.w[slot] -= (rate * dw / np.sqrt(gw[slot])).astype(np.float32)
                self.v[slot] -= (rate * dv / np.sqrt(gv[slot])).astype(np.float32)
        return self


def held_out(doc_id):
    """Rows that no label is learned from: crc32 of the id as text, mod 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_toxicity(docs: DataFrame, labels: DataFrame, bits: int = BITS, factors: int = FACTORS,
                 max_rows: int = MAX_ROWS, seed: int = 7) -> FactorizationMachine:
    fm = _fitted(docs, labels, bits, factors, max_rows, seed)
    release_driver(docs.sparkSession)  # the sample: the driver goes on to other stages
    return fm


def _fitted(docs: DataFrame, labels: DataFrame, bits: int, factors: int, max_rows: int, seed: int) -> FactorizationMachine:
    ship_package(docs.sparkSession)
    known = (
        labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
        .filter(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    )
    counts = dict(known.groupBy("label").count().collect())  # two numbers
    n0, n1 = counts.get(0, 0), counts.get(1, 0)
    fm = FactorizationMachine(bits, factors, seed)
    if not n0 or not n1:
        share = n1 / max(n0 + n1, 1)
        fm.v[:] = 0
        fm.w0 = 30.0 if share == 1 else -30.0
        return fm
    want1 = min(n1, max_rows // 2)
    want0 = min(n0, max_rows - want1)
    order = F.xxhash64(F.lit(seed), F.col("doc_id"))
    picked = None
    for label, want in ((1, want1), (0, want0)):
        part = known.filter(F.col("label") == label).orderBy(order).limit(want)
        picked = part if picked is None else picked.unionByName(part)
    # at most max_rows ids, so they can be broadcast; of an id's rows one stays, whichever tasks hold them
    one = F.min(F.struct(F.xxhash64("text").alias("salt"), "text"))["text"].alias("text")
    sample = (docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").groupBy("doc_id", "label").agg(one)
              .select("label", "text").mapInArrow(_slot_batches(bits), "label int, slots binary").toArrow())
    rows = [np.frombuffer(x, "<i4") for x in sample.column("slots").to_pylist()]
    y = np.array(sample.column("label").to_pylist(), float)
    if not 0 < y.sum() < len(y):  # no labelled row of one class has a document
        fm.v[:] = 0
        fm.w0 = float(np.log(n1 / n0))
        return fm
    order = np.lexsort((np.array([zlib.crc32(r.tobytes()) for r in rows]), y))  # whatever order the tasks gave
    rows, y = [rows[i] for i in order], y[order]
    fm.fit(rows, y, seed=seed)
    # back to the share of toxic rows among all training rows
    fm.w0 += np.log(n1 / n0) - np.log(y.sum() / (1 - y).sum())
    return fm


def _score_batches(model, bits: int):
    def run(batches):
        from strata.llm.tokens import forget

        forget()  # a reused worker may still hold an encoder's pieces
        fm = model.value
        for b in batches:
            at = b.schema.get_field_index("text")
            for a in range(0, b.num_rows, 256):
                part = b.slice(a, 256)
                slots = [slots_of(t, bits) for t in part.column(at).to_pylist()]
                n = len(slots)
                idx = np.concatenate(slots) if n else np.empty(0, np.int32)
                score = fm.proba(idx, np.repeat(np.arange(n), [len(s) for s in slots]), n)
                yield part, score
    return run


def score_toxicity(docs: DataFrame, labels: DataFrame, bits: int = BITS, **fit) -> DataFrame:
    """doc_id, held_out and score of every document row."""
    fm = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, bits, **fit))
    score = _score_batches(fm, bits)

    def run(batches):
        for part, s in score(batches):
            yield pa.record_batch({"doc_id": part.column(0), "score": pa.array(s)})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, score double").select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, bits: int = BITS, **fit) -> DataFrame:
    """The rows that score below ``threshold``, with all their columns."""
    fm = docs.sparkSession.sparkContext.broadcast(fit_toxicity(docs, labels, bits, **fit))
    score = _score_batches(fm, bits)

    def run(batches):
        for part, s in score(batches):
            yield part.filter(pa.array(s < threshold))

    return docs.mapInArrow(run, docs.schema)
