"""Quality rules: hashed n-gram log-likelihood ratio, plus plain measures.

Two multinomials over ``buckets`` hashed byte n-grams, and one more event for a word
pair whose words are the same, are counted in one scan of all documents: the raw corpus (every document) and the trusted target
(documents whose label says good). A document's score is the mean over its
n-grams of ``log p_target - log p_raw`` (add-``alpha`` smoothing), so length does
not move it, and every document is held against the same fixed threshold: no
sampling and no noise. The threshold leaves room for languages whose share of the
trusted documents is down to 0.6 of their share of the corpus; junk scores -1 and less. A document fails if it misses a base measure or scores
below the threshold.

The trusted ids are all distinct ids with quality 1, joined to the documents as a
flag: both multinomials cover all of their documents at every size. Ratios are kept
in fixed point (1e-6), so sums are exact and a score does not depend on how rows
are batched.

Defined results: null and empty texts have no words, score 0, and fail the base
measure; null ids get their result too but are never trusted; without trusted
documents (or without labels) every ratio is 0 and the base measures decide
alone; repeated rows are judged one by one; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.tables import materialize, plain_names, table
from auric.llm.text import (NONSPACE, U, alphabet, per_row, runs, same_bytes, seeded, shingles,
                            words)

N = 3
BUCKETS = 1 << 16
ALPHA = 1.0
THRESHOLD = -0.5
MIN_WORDS = 20
MAX_REPEAT_PCT = 30
WINDOW = 8

_SYMBOL = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_FIRST_BYTE = (np.arange(256) & 0xC0) != 0x80      # of a code point
_LINES = alphabet(lambda b: b != 0x0A, lower=False)


def ngram_buckets(data: np.ndarray, offsets: np.ndarray, n: int, buckets: int):
    """Bucket of the n-gram at each byte, and whether it ends inside its text."""
    size = len(data) - n + 1
    if size <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, bool)
    key = np.zeros(size, np.uint32)
    for k in range(n):
        key = key * np.uint32(257) + data[k:k + size]
    key = (key * np.uint32(2654435761)) >> np.uint32(32 - (buckets.bit_length() - 1))
    inside = np.ones(size, bool)
    for k in range(1, n):                          # begins k bytes before a boundary
        at = offsets[1:-1] - k
        inside[at[(at >= 0) & (at < size)]] = False
    return key, inside


def same_pairs(w) -> np.ndarray:
    """Places of the words that equal the word before them in their text."""
    same = np.zeros(len(w.hash), bool)
    same[1:] = w.hash[1:] == w.hash[:-1]
    same[w.first[:-1][w.counts > 0]] = False
    return same


def _counter(n: int, buckets: int):
    def run(batches):
        raw, good = np.zeros(buckets + 1, np.int64), np.zeros(buckets + 1, np.int64)
        for b in batches:
            known = b.column(1).to_numpy(zero_copy_only=False)
            for lo, hi, data, off in runs(b.column(0)):
                key, ok = ngram_buckets(data, off, n, buckets)
                w = words(data, off, NONSPACE)
                pairs = per_row(same_pairs(w), w.first)
                raw += np.bincount(key[ok], minlength=buckets + 1)
                raw[buckets] += pairs.sum()
                if known[lo:hi].any():
                    mine = np.repeat(known[lo:hi], np.diff(off))[:len(key)]
                    good += np.bincount(key[ok & mine], minlength=buckets + 1)
                    good[buckets] += pairs[known[lo:hi]].sum()
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at), pa.array(raw[at]), pa.array(good[at])], ["b", "raw", "good"])
    return run


def trusted_ids(labels: DataFrame, id_col: str = "doc_id",
                label_col: str = "quality") -> DataFrame:
    """All distinct ids labelled good (column i)."""
    return (labels.where((F.col(label_col) == 1) & F.col(id_col).isNotNull())
            .select(F.col(id_col).cast("bigint").alias("i")).distinct())


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        label_col: str = "quality", n: int = N, buckets: int = BUCKETS,
        alpha: float = ALPHA) -> np.ndarray:
    """Log ratio of each bucket, in millionths (int64[buckets + 1])."""
    # from files, so that the join's sides are bare exchanges and a repeated id's can be split
    good_ids = materialize(trusted_ids(labels, id_col, label_col), "trusted-ids")
    got = (docs.select(F.col(id_col).cast("bigint").alias("d"),
                       F.col(text_col).cast("string").alias("t"))
           .join(good_ids.hint("shuffle_hash"), F.col("d") == F.col("i"), "left")
           .select("t", F.col("i").isNotNull().alias("known"))
           .mapInArrow(_counter(n, buckets), "b bigint, raw bigint, good bigint")
           .groupBy("b").agg(F.sum("raw").alias("raw"), F.sum("good").alias("good"))
           .collect())                             # at most ``buckets`` + 1 rows
    raw, good = np.zeros(buckets + 1), np.zeros(buckets + 1)
    for r in got:
        raw[r["b"]], good[r["b"]] = r["raw"], r["good"]
    if not good.sum():
        return np.zeros(buckets + 1, np.int64)
    seen = max(1, int((raw > 0).sum()))
    ratio = (np.log((good + alpha) / (good.sum() + alpha * seen))
             - np.log((raw + alpha) / (raw.sum() + alpha * seen)))
    return np.where(raw > 0, np.rint(ratio * 1e6), 0).astype(np.int64)


def first_equal(key: np.ndarray, equal) -> np.ndarray:
    """For each thing the first one equal to it (itself, if none before is). Things of
    unlike keys differ; ``equal(i, j)`` tells for pairs of like keys."""
    order = np.argsort(key, kind="stable")
    first = np.arange(len(key))
    left = order                                   # sorted by key, then place
    while len(left):
        new = np.ones(len(left), bool)
        new[1:] = key[left][1:] != key[left][:-1]
        head = left[np.maximum.accumulate(np.where(new, np.arange(len(left)), 0))]
        rest = np.flatnonzero(~new)
        same = equal(left[rest], head[rest])
        first[left[rest[same]]] = head[rest[same]]
        left = left[rest[~same]]                   # like keys, other contents: once more
    return first


def _equal_lines(lines, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    size = lines.end[i] - lines.start[i]
    same = size == lines.end[j] - lines.start[j]
    at = np.flatnonzero(same & (lines.row[i] == lines.row[j]))
    same[:] = False
    same[at] = same_bytes(lines.data, lines.start[i[at]], lines.data, lines.start[j[at]], size[at])
    return same


def _equal_windows(w, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Of windows that begin at words i and j: the same words, compared as bytes."""
    same = w.row[i] == w.row[j]
    for k in range(WINDOW):
        at = np.flatnonzero(same)
        a, b = i[at] + k, j[at] + k
        size = w.end[a] - w.start[a]
        like = (w.hash[a] == w.hash[b]) & (size == w.end[b] - w.start[b])
        same[at[~like]] = False
        at, a, b = at[like], a[like], b[like]
        same[at] = same_bytes(w.data, w.start[a], w.data, w.start[b], size[like])
    return same


def measures(data: np.ndarray, off: np.ndarray, ratio: np.ndarray, n: int) -> dict:
    """All measures of a run of texts, by row."""
    w = words(data, off, NONSPACE)
    by_byte = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[off])
    out = {"n_words": w.counts,
           "word_chars": by_byte(NONSPACE.inside[data] & _FIRST_BYTE[data]),
           "n_symbols": by_byte(_SYMBOL[data])}

    lines = words(data, off, _LINES)
    has_word = (np.searchsorted(w.start, lines.end) - np.searchsorted(w.start, lines.start)) > 0
    key, at = (lines.hash ^ seeded(lines.row.astype(U), 7))[has_word], np.flatnonzero(has_word)
    first = first_equal(key, lambda i, j: _equal_lines(lines, at[i], at[j]))
    out["n_dup_lines"] = np.bincount(lines.row[at][first != np.arange(len(at))],
                                     minlength=len(off) - 1)

    h, at = shingles(w, WINDOW)
    key = h ^ seeded(w.row[at].astype(U), 7)
    first = first_equal(key, lambda i, j: _equal_windows(w, at[i], at[j]))
    twice = np.bincount(first, minlength=len(at))[first] > 1
    edge = np.zeros(len(w.hash) + 1, np.int64)
    np.add.at(edge, at[twice], 1)
    np.add.at(edge, at[twice] + WINDOW, -1)
    out["n_repeat_words"] = per_row(np.cumsum(edge[:-1]) > 0, w.first)

    key, ok = ngram_buckets(data, off, n, len(ratio) - 1)
    value, each = np.zeros(len(data), np.int64), np.zeros(len(data), np.int64)
    value[:len(key)] = np.where(ok, ratio[key], 0)
    each[:len(key)] = ok
    pairs = per_row(same_pairs(w), w.first)
    total, grams = by_byte(value) + pairs * ratio[-1], by_byte(each) + pairs
    out["score"] = total / np.maximum(grams, 1) / 1e6
    return out


def _verdict(m: dict, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    failed = ((m["n_words"] < MIN_WORDS)
              | (100 * m["n_repeat_words"] > MAX_REPEAT_PCT * m["n_words"]))
    return failed, ~failed & (m["score"] >= threshold)


_LONGS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          threshold: float = THRESHOLD, n: int = N, **fitting) -> DataFrame:
    """One row per document: id, the measures, base_failed, score, kept."""
    bc = docs.sparkSession.sparkContext.broadcast(
        fit(docs, labels, id_col, text_col, n=n, **fitting))
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        for b in batches:
            for lo, hi, data, off in runs(b.column(1)):
                m = measures(data, off, bc.value, n)
                failed, kept = _verdict(m, threshold)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo)]
                    + [pa.array(m[c].astype(np.int64)) for c in _LONGS]
                    + [pa.array(failed), pa.array(m["score"]), pa.array(kept)],
                    [id_col, *_LONGS, "base_failed", "score", "kept"])

    return (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
            .mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{c} bigint" for c in _LONGS)
                        + ", base_failed boolean, score double, kept boolean"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id",
              text_col: str = "text", threshold: float = THRESHOLD, n: int = N,
              **fitting) -> DataFrame:
    """The rows of ``docs``, all columns, that ``judge`` would keep."""
    bc = docs.sparkSession.sparkContext.broadcast(
        fit(docs, labels, id_col, text_col, n=n, **fitting))
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            for lo, hi, data, off in runs(b.column(at)):
                kept = _verdict(measures(data, off, bc.value, n), threshold)[1]
                yield b.slice(lo, hi - lo).filter(pa.array(kept))

    plain = plain_names(docs)
    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLE: dict[str, str] = {}
