"""Benchmark decontamination: prefix-filtered set join of item windows.

A window is ``window`` consecutive words of an item (all words of a shorter
item). A window is contained in a document only if each of its shingles is, so
one necessary shingle is enough to find it: the shingles of a window are
ordered by how often they occur in the whole corpus and the rarest is its
prefix. Documents are joined on the prefix shingles only; the place of the
shingle gives the one start the window could have (positional bound), which
must leave room for the whole window inside the document (length bound). Hash
by hash, then byte by byte, the words there are compared with the window's.

Windows are built from the items in tasks and kept as a table of different windows with
their items. Two scans of the documents: one counts the items' shingles, one joins. Both
are narrow (no shuffle of texts); the first ends in a sum per shingle. The windows are
sent to the executors in blocks of at most ``block_bytes`` (counted before a block is
collected; windows of one item may lie in several), with two scans for each block, so a
benchmark and an item of any size keep the same memory.

Defined results: null and empty texts have no words and are never hit; an item
without words has no windows; null item ids are left out of ``items`` but their
windows still hit; rows are never merged, so repeated rows (and null or repeated
ids) give a result each; other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.tables import blocks, materialize, plain_names, table
from auric.llm.text import ALNUM, Lookup, per_row, runs, shingles, words

WINDOW = 10
SHINGLE = 3
BLOCK_BYTES = 32 << 20


@dataclass
class Windows:
    """Different windows of a block."""

    hashes: np.ndarray            # uint64[n, window], 0 beyond the length
    length: np.ndarray
    text: list[bytes]             # the words, one space between
    items: list[list[str]]        # ids of the items that have the window

    def shingle_table(self, size: int):
        """(hash, window, offset) of every shingle of every window."""
        out = []
        for n in np.unique(self.length):
            q = min(size, int(n))
            at = np.flatnonzero(self.length == n)
            for k in range(int(n) - q + 1):
                h = _combine(self.hashes[at, k:k + q])
                out.append((h, at, np.full(len(at), k), np.full(len(at), q)))
        if not out:
            return tuple(np.zeros(0, t) for t in (np.uint64, np.int64, np.int64, np.int64))
        return tuple(np.concatenate(x) for x in zip(*out))


def _combine(h: np.ndarray) -> np.ndarray:
    from auric.llm import text as t
    acc = h[:, 0]
    for k in range(1, h.shape[1]):
        acc = acc * t._P + h[:, k]
    return t.mix(acc + np.uint64(h.shape[1]))


def build_windows(rows: list[tuple[str | None, str | None]], window: int) -> Windows:
    found: dict[bytes, int] = {}
    hashes, length, items = [], [], []
    texts = pa.array([t for _, t in rows], pa.large_string())
    for lo, hi, data, off in runs(texts):
        w = words(data, off, ALNUM)
        for r in range(hi - lo):
            a, b = int(w.first[r]), int(w.first[r + 1])
            n = min(window, b - a)
            for s in range(a, b - n + 1) if n else ():
                key = w.joined(s, s + n)
                i = found.setdefault(key, len(found))
                if i == len(items):
                    h = np.zeros(window, np.uint64)
                    h[:n] = w.hash[s:s + n]
                    hashes.append(h)
                    length.append(n)
                    items.append(set())
                if rows[lo + r][0] is not None:
                    items[i].add(rows[lo + r][0])
    return Windows(np.array(hashes, np.uint64).reshape(-1, window),
                   np.array(length, np.int64), list(found), [sorted(x) for x in items])


class Prefixes:
    """For each window its rarest shingle, to look up in documents."""

    def __init__(self, w: Windows, size: int, counts: dict[int, int]):
        h, win, off, q = w.shingle_table(size)
        rank = np.array([counts.get(int(x), 0) for x in h.view(np.int64)], np.int64)
        order = np.lexsort((off, h, rank, win))
        first = order[np.unique(win[order], return_index=True)[1]]
        self.windows = w
        self.by_size = {}
        for k in np.unique(q[first]):
            sel = first[q[first] == k]
            sel = sel[np.argsort(h[sel], kind="stable")]
            keys, begin = np.unique(h[sel], return_index=True)
            self.by_size[int(k)] = (Lookup(keys), np.append(begin, len(sel)),
                                    win[sel], off[sel])

    def match(self, w) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, first word, window) of each occurrence in the run ``w``."""
        rows = w.row
        out = [(np.zeros(0, np.int64),) * 3]
        for size, (lookup, begin, win, off) in self.by_size.items():
            h, at = shingles(w, size)
            pos, key = lookup.find(h)
            many = begin[key + 1] - begin[key]
            each = np.repeat(np.arange(len(pos)), many)
            entry = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
            entry = entry + begin[key][each]
            v = win[entry]
            start = at[pos][each] - off[entry]
            n = self.windows.length[v]
            row = rows[at[pos][each]]
            ok = (start >= w.first[row]) & (start + n <= w.first[row + 1])
            row, start, v, n = row[ok], start[ok], v[ok], n[ok]
            for j in range(int(n.max()) if len(n) else 0):
                there = w.hash[np.minimum(start + j, len(w.hash) - 1)]
                ok = (j >= n) | (there == self.windows.hashes[v, j])
                row, start, v, n = row[ok], start[ok], v[ok], n[ok]
            ok = np.fromiter((w.joined(s, s + k) == self.windows.text[i] for s, k, i in
                              zip(start.tolist(), n.tolist(), v.tolist())), bool, len(v))
            out.append((row[ok], start[ok], v[ok]))
        row, start, v = (np.concatenate(x) for x in zip(*out))
        return row, start, v


def _shingle_counts(docs: DataFrame, text_col: str, wanted: np.ndarray, size: int,
                    sizes: list[int]) -> dict[int, int]:
    """How often each wanted shingle occurs in all documents."""
    bc = docs.sparkSession.sparkContext.broadcast(np.unique(wanted))

    def count(batches):
        look = Lookup(bc.value)
        n = np.zeros(len(look.keys), np.int64)
        for b in batches:
            for _, _, data, off in runs(b.column(0)):
                w = words(data, off, ALNUM)
                for q in sizes:
                    _, key = look.find(shingles(w, q)[0])
                    n += np.bincount(key, minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(look.keys[at].view(np.int64)), pa.array(n[at])], ["h", "n"])

    got = (docs.select(F.col(text_col).cast("string").alias("t"))
           .mapInArrow(count, "h bigint, n bigint")
           .groupBy("h").agg(F.sum("n").alias("n")).collect())
    bc.unpersist()
    return {r["h"]: r["n"] for r in got}         # at most the block's shingles


def _window_rows(window: int):
    """(text, hashes, length, items) of the different windows of a task's items."""
    names = ["text", "hashes", "length", "items"]

    def run(batches):
        for b in batches:
            for k in range(b.num_rows):            # an item at a time, whole
                w = build_windows([(b.column(0)[k].as_py(), b.column(1)[k].as_py())], window)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(w.text, pa.binary()),
                     pa.array([h.tobytes() for h in w.hashes], pa.binary()),
                     pa.array(w.length, pa.int32()), pa.array(w.items, pa.list_(pa.string()))],
                    names)
    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int):
    """All windows, in blocks of at most ``block_bytes``."""
    items = benchmark.select(F.col(item_col).cast("string").alias("i"),
                             F.col(text_col).cast("string").alias("t")).distinct()
    found = (items.mapInArrow(_window_rows(window),
                              "text binary, hashes binary, length int, items array<string>")
             .groupBy("text").agg(F.first("hashes").alias("hashes"),
                                  F.first("length").alias("length"),
                                  F.array_sort(F.array_distinct(F.flatten(
                                      F.collect_list("items")))).alias("items"))
             .withColumn("key", F.xxhash64("text")))
    found = materialize(found, "windows")
    size = (F.length("text") + F.length("hashes")
            + F.aggregate("items", F.lit(0), lambda n, x: n + F.length(x) + 8))
    for rows in blocks(found, "key", (size, block_bytes)):
        yield Windows(np.frombuffer(b"".join(r["hashes"] for r in rows), np.uint64)
                      .reshape(-1, window),
                      np.array([r["length"] for r in rows], np.int64),
                      [bytes(r["text"]) for r in rows], [r["items"] for r in rows])


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


_EXTRA = [pa.field("_spans", pa.list_(pa.int64())), pa.field("_items", pa.list_(pa.string()))]


def _pass(text_at: int, prefixes, width: int, final):
    """A scan with one block of items: adds its hits to those of earlier blocks,
    and after the last block turns them into the result with ``final``."""

    def run(batches):
        p = prefixes.value
        for b in batches:
            for lo, hi, data, off in runs(b.column(text_at)):
                part = b.slice(lo, hi - lo)
                w = words(data, off, ALNUM)
                row, start, v = p.match(w)
                length = p.windows.length[v]
                items = [set() for _ in range(hi - lo)]
                spans = [[] for _ in range(hi - lo)]
                if part.num_columns > width:      # from earlier blocks
                    spans = [list(x) for x in part.column(width).to_pylist()]
                    items = [set(x) for x in part.column(width + 1).to_pylist()]
                for r, s, n, i in zip(row.tolist(), (start - w.first[row]).tolist(),
                                      length.tolist(), v.tolist()):
                    spans[r] += (s, n)
                    items[r].update(p.windows.items[i])
                own = [part.column(k) for k in range(width)]
                if final is None:
                    own += [pa.array(spans, _EXTRA[0].type),
                            pa.array([sorted(x) for x in items], _EXTRA[1].type)]
                    names = part.schema.names[:width] + [f.name for f in _EXTRA]
                    yield pa.RecordBatch.from_arrays(own, names)
                else:
                    yield final(part, own, w.counts, _covered(spans, w), items)
    return run


def _covered(spans: list[list[int]], w) -> np.ndarray:
    """Words of each row inside any of its spans."""
    edge = np.zeros(len(w.hash) + 1, np.int64)
    for r, x in enumerate(spans):
        if x:
            s = np.array(x[::2]) + w.first[r]
            np.add.at(edge, s, 1)
            np.add.at(edge, s + np.array(x[1::2]), -1)
    return per_row(np.cumsum(edge[:-1]) > 0, w.first)


def _scan(frame: DataFrame, text_at: int, docs: DataFrame, text_col: str,
          benchmark: DataFrame, item_col: str, item_text_col: str, window: int,
          shingle: int, block_bytes: int, final, schema) -> DataFrame:
    spark, width = frame.sparkSession, len(frame.columns)
    state = frame
    every = _blocks(benchmark, item_col, item_text_col, window, block_bytes)
    w = next(every, None) or build_windows([], window)
    while True:
        then = next(every, None)
        h, _, _, q = w.shingle_table(shingle)
        counts = _shingle_counts(docs, text_col, h, shingle,
                                 [int(x) for x in np.unique(q)]) if len(h) else {}
        bc = spark.sparkContext.broadcast(Prefixes(w, shingle, counts))
        if then is None:
            return state.mapInArrow(_pass(text_at, bc, width, final), schema)
        fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}"
                           for f in frame.schema.fields)
        state = materialize(state.mapInArrow(
            _pass(text_at, bc, width, None),
            f"{fields}, _spans array<bigint>, _items array<string>"), "decontam")
        w = then


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW,
                  shingle: int = SHINGLE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per document: id, n_words, n_hit (words inside an occurrence of a
    window), n_items, items (ids, sorted as strings), items_sha256, contaminated."""
    kind = docs.schema[id_col].dataType.simpleString()
    frame = docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))

    def final(part, own, n_words, n_hit, items):
        lists = [sorted(x) for x in items]
        sha = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in lists]
        return pa.RecordBatch.from_arrays(
            [own[0], pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()),
             pa.array([len(x) for x in lists], pa.int64()), pa.array(lists, pa.list_(pa.string())),
             pa.array(sha), pa.array(n_hit > 0)],
            [id_col, "n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated"])

    return _scan(frame, 1, docs, text_col, benchmark, item_col, item_text_col, window,
                 shingle, block_bytes, final,
                 f"`{id_col}` {kind}, n_words bigint, n_hit bigint, n_items bigint, "
                 "items array<string>, items_sha256 string, contaminated boolean")


def without_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                         item_col: str = "item_id", item_text_col: str = "text",
                         window: int = WINDOW, shingle: int = SHINGLE,
                         block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The rows of ``docs``, all columns, that no window occurs in."""
    plain = plain_names(docs)
    names = plain.columns

    def final(part, own, n_words, n_hit, items):
        clean = pa.RecordBatch.from_arrays(own, names)
        return clean.filter(pa.array(n_hit == 0))

    return _scan(plain, docs.columns.index(text_col), docs, text_col, benchmark, item_col,
                 item_text_col, window, shingle, block_bytes, final, plain.schema
                 ).toDF(*docs.columns)


def op2_decontamination(spark, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op2_decontamination": op2_decontamination}
ORACLE: dict[str, str] = {}
