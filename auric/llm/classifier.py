"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates and scored as sparse dot products.

Words are runs of letters, digits and non-ASCII characters, and runs of
punctuation, as written. Features are single words and pairs of neighbours, hashed
to ``dims`` places; a pair of equal words is one feature whatever the word. A
feature's value is its share of the document's features times ``SCALE``, so length does not
move a score, and a score is a sum of weights over occurrences.

Training takes a bounded sample of labelled rows (``train_docs``, documented
parameter): those with the smallest hash of their id among the labelled rows with
crc32(id as text) mod 4 other than 2. Only their hashed features reach the driver,
which makes ``epochs`` sequential passes in a fixed order. Scoring is one narrow scan of
every whole text; labels, ids, languages and sources never enter a score.

Defined results: null and empty texts have no features and get the score of the
bias alone; a null id is not held out; labels that are null or contradict one
another for an id are left out of training; without labels every score is 0.5;
repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.tables import table
from auric.llm.text import PIECES, U, mix, per_row, runs, seeded, words, _P

DIMS = 1 << 18
SCALE = 10.0
TRAIN_DOCS = 8_000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 1e-4, 1e-4
CUT = 0.7
HELD_OUT = 2


def features(data: np.ndarray, off: np.ndarray, dims: int):
    """(feature of each occurrence, first occurrence of each row, its last + 1):
    single words first, then pairs, both in order of rows."""
    w = words(data, off, PIECES)
    one = seeded(w.hash, 31) & U(dims - 1)
    pair = np.flatnonzero(w.row[1:] == w.row[:-1]) if len(w.hash) > 1 else np.zeros(0, np.int64)
    a, b = w.hash[pair], w.hash[pair + 1]
    two = np.where(a == b, U(1), mix(a * _P + b)) & U(dims - 1)
    pairs = np.concatenate([[0], np.cumsum(np.maximum(w.counts - 1, 0))])
    return one.astype(np.int64), w.first, two.astype(np.int64), pairs


class Ftrl:
    """Follow the regularised leader, per coordinate, for logistic loss."""

    def __init__(self, dims: int, alpha=ALPHA, beta=BETA, l1=L1, l2=L2):
        self.z, self.n = np.zeros(dims + 1), np.zeros(dims + 1)    # the last: bias
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = -(z - np.sign(z) * self.l1) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def update(self, at: np.ndarray, x: np.ndarray, y: int) -> None:
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
        n = self.n[at]
        sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] = n + g * g


def training_ids(labels: DataFrame, limit: int, id_col: str, label_col: str):
    """Sorted ids and their labels, of the bounded sample."""
    rows = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
            .where(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 != HELD_OUT)
            .groupBy(F.col(id_col).cast("bigint").alias("i"))
            .agg(F.min(label_col).alias("y"), F.max(label_col).alias("y2")).where("y = y2")
            .orderBy(F.xxhash64("i"), "i").select("i", "y").limit(limit).collect())
    rows = sorted((r["i"], r["y"]) for r in rows)
    return np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], np.int8)


def _training_rows(docs: DataFrame, ids: np.ndarray, id_col: str, text_col: str, dims: int):
    known = docs.sparkSession.sparkContext.broadcast(ids)

    def run(batches):
        for b in batches:
            mine = np.isin(b.column(0).fill_null(0).to_numpy(zero_copy_only=False), known.value)
            mine &= b.column(0).is_valid().to_numpy(zero_copy_only=False)
            b = b.filter(pa.array(mine))
            for lo, hi, data, off in runs(b.column(1)):
                one, f1, two, f2 = features(data, off, dims)
                at, share = [], []
                for r in range(hi - lo):
                    every = np.concatenate([one[f1[r]:f1[r + 1]], two[f2[r]:f2[r + 1]]])
                    place, count = np.unique(every, return_counts=True)
                    at.append(place.astype("<i4").tobytes())
                    share.append((count * (SCALE / max(1, len(every)))).astype("<f4").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(at, pa.binary()),
                     pa.array(share, pa.binary())], ["i", "at", "x"])

    return (docs.select(F.col(id_col).cast("bigint").alias("i"),
                        F.col(text_col).cast("string").alias("t"))
            .mapInArrow(run, "i bigint, at binary, x binary")
            # a repeated id counts once, with the least of its texts' features
            .groupBy("i").agg(F.min(F.struct("at", "x")).alias("row")).select("i", "row.*"))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", dims: int = DIMS, train_docs: int = TRAIN_DOCS,
          epochs: int = EPOCHS) -> np.ndarray:
    """Weights of the features, then the bias (float64[dims + 1])."""
    ids, y = training_ids(labels, train_docs, id_col, label_col)
    rows = _training_rows(docs, ids, id_col, text_col, dims).collect() if len(ids) else []
    rows.sort(key=lambda r: (int(seeded(np.array([r["i"]], np.int64).view(U), 37)[0]),
                             r["at"], r["x"]))
    model = Ftrl(dims)
    for _ in range(epochs):
        for r in rows:
            at = np.append(np.frombuffer(r["at"], "<i4"), dims)
            x = np.append(np.frombuffer(r["x"], "<f4"), 1.0).astype(np.float64)
            model.update(at, x, int(y[np.searchsorted(ids, r["i"])]))
    return model.weights()


def score(docs: DataFrame, weights: np.ndarray, id_col: str = "doc_id",
          text_col: str = "text", cut: float = CUT) -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    dims = len(weights) - 1
    # fixed point, so that a sum does not depend on how rows are batched
    bc = docs.sparkSession.sparkContext.broadcast(np.rint(weights * 1e9).astype(np.int64))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        w = bc.value
        for b in batches:
            for lo, hi, data, off in runs(b.column(1)):
                one, f1, two, f2 = features(data, off, dims)
                total = per_row(w[one], f1) + per_row(w[two], f2)
                many = np.maximum(np.diff(f1) + np.diff(f2), 1)
                s = 1 / (1 + np.exp(-np.clip(total / 1e9 * SCALE / many + w[dims] / 1e9,
                                             -35, 35)))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(s)], ["_id", "score"])

    held = F.crc32(F.col("_id").cast("string").cast("binary")) % 4 == HELD_OUT
    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
            .mapInArrow(run, f"_id {kind}, score double")
            .select(F.col("_id").alias(id_col), F.coalesce(held, F.lit(False)).alias("held_out"),
                    "score", (F.col("score") >= cut).cast("int").alias("predicted")))


def op7_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score(docs, train(docs, table(spark, sf_dir, "labels")))


QUERIES = {"op7_quality_classifier": op7_quality_classifier}
ORACLE: dict[str, str] = {}
