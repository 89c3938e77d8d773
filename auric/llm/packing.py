"""Best-two-fit packing of tokenized documents into fixed-length sequences.

Documents become pieces in one narrow scan: ids of the whole text, then the end
id; a document longer than a sequence is cut so that only its first piece can be
shorter than one. Only the pieces' descriptions travel on (no ids, no text).

All pieces are packed as one, by best-two-fit: a bin is filled greedily with the longest
piece that still fits; if a gap is left, its smallest piece is taken out again and
replaced by the two unpacked pieces that fill the enlarged gap most tightly, if these
fill more than the piece did. What a bin gets depends on the lengths that are left, not
on which piece has one, so bins follow from the number of pieces of each length: at
most ``size`` numbers, however large the corpus is. The same bin is made as often as its
lengths last, so the driver plans patterns with a number of bins each (bounded by size *
ln size), not bins. A piece takes its place from its rank among those of its length: its
task's offset plus its number there.

Tokenizing remembers the ids of text between spaces: the vocabulary's pre-tokens
never reach across a space that follows a character other than white space, so a
text's ids are those of its stretches one after the other. A text that holds an added
token of the vocabulary goes through the tokenizer whole. The memory is bounded
(two generations of ``CACHE_ENTRIES``); it changes no result.

Defined results: null and empty texts are one piece, the end id alone; null and
repeated ids and repeated rows are packed row by row; other columns are ignored.
"""

from __future__ import annotations

import math
import os
import re
import struct
import zlib
from bisect import bisect_right, insort
from collections import Counter
from string import punctuation

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.tables import materialize, table

SEQUENCE = 2048
END_ID = 0
CACHE_ENTRIES = 600_000
GROUP_CHARS = 1 << 20
TOKENIZER = "byte_bpe_50k.json"

_INNER_SPACE = re.compile(r"(?<=\S) ")
_AFTER_SPACE = re.compile(r"\s ")
_PAST_LATIN = "\u0250"       # below it, what is alphabetic has long been settled
# byte-level vocabularies write bytes as characters: printable ones as themselves,
# the others, in order, from U+0100 on
_PRINTABLE = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
_BYTE_SIGNS = {b: 0x100 + k for k, b in enumerate(sorted({*range(256)} - _PRINTABLE))}
_BYTE_SPACE = chr(_BYTE_SIGNS[0x20])
_loaded: dict[str, "Ids"] = {}


class Known(dict):
    """Ids of stretches, found on first use. ``lead`` goes before each; what the
    generation before this one knew moves over when it is used again."""

    def __init__(self, ids: "Ids", lead: str, older: dict | None = None):
        super().__init__()
        self.ids, self.lead, self.older = ids, lead, older or {}

    def __missing__(self, part: str) -> bytes:
        found = self.older.get(part)
        if found is None:
            found = self.ids.of(self.lead, part)
        self[part] = found
        return found

    def renewed(self) -> "Known":
        return Known(self.ids, self.lead, dict(self)) if len(self) > CACHE_ENTRIES else self


class Ids:
    """Ids of texts as little-endian 32-bit bytes."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added)) or r"(?!)")
        self.spaced, self.plain = Known(self, " "), Known(self, "")

    def of(self, lead: str, part: str) -> bytes:
        """A Latin word is one pre-token, so its ids are the model's alone; ASCII signs
        after it are the next. All else goes through the tokenizer."""
        word = part if part.isalpha() else part.rstrip(punctuation)
        if not (word.isalpha() and (word.isascii() or max(word) < _PAST_LATIN)):
            ids = self.tokenizer.encode(lead + part, add_special_tokens=False).ids
        elif len(word) < len(part):
            return (self.spaced if lead else self.plain)[word] + self.plain[part[len(word):]]
        else:
            raw = word if word.isascii() else word.encode().decode("latin-1").translate(_BYTE_SIGNS)
            ids = [t.id for t in self.model.tokenize(_BYTE_SPACE + raw if lead else raw)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        out = []
        for t in texts:
            self.spaced, self.plain = self.spaced.renewed(), self.plain.renewed()
            if self.added.search(t):
                ids = self.tokenizer.encode(t, add_special_tokens=False).ids
                out.append(struct.pack(f"<{len(ids)}I", *ids))
                continue
            first, *rest = _INNER_SPACE.split(t) if _AFTER_SPACE.search(t) else t.split(" ")
            out.append(self.plain[first] + b"".join(map(self.spaced.__getitem__, rest)))
        return out


def tokenizer_path(path: str | None = None) -> str:
    if path:
        return path
    import public_tokenizers
    return public_tokenizers.path(TOKENIZER)


def _ids(path: str | None) -> Ids:
    path = tokenizer_path(path)
    if path not in _loaded:
        _loaded[path] = Ids(path)
    return _loaded[path]


def cut(n: int, size: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    first = n - size * (math.ceil(n / size) - 1)
    return [(0, first)] + [(s, size) for s in range(first, n, size)]


def _tokenize(path: str | None, size: int, end_id: int):
    end = np.array([end_id], "<u4").tobytes()

    def groups(texts):
        lo, chars = 0, 0
        for k, t in enumerate(texts):
            chars += len(t)
            if chars >= GROUP_CHARS:
                yield lo, k + 1
                lo, chars = k + 1, 0
        if lo < len(texts):
            yield lo, len(texts)

    def run(batches):
        ids = _ids(path)
        task = TaskContext.get().partitionId()
        seen = np.zeros(size + 1, np.int64)        # pieces of each length so far
        for b in batches:
            texts = ["" if t is None else t for t in b.column(1).to_pylist()]
            for lo, hi in groups(texts):
                who, piece, start, length, crc = [], [], [], [], []
                for k, raw in enumerate(ids.encode(texts[lo:hi])):
                    raw = memoryview(raw + end)
                    for i, (s, n) in enumerate(cut(len(raw) // 4, size)):
                        who.append(lo + k)
                        piece.append(i)
                        start.append(s)
                        length.append(n)
                        crc.append(zlib.crc32(raw[4 * s:4 * (s + n)]))
                n = np.array(length, np.int64)
                order = np.argsort(n, kind="stable")
                nth = np.empty(len(n), np.int64)
                nth[order] = seen[n[order]] + np.arange(len(n)) - np.searchsorted(n[order], n[order])
                seen += np.bincount(n, minlength=size + 1)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(pa.array(who, pa.int64())), pa.array(piece, pa.int32()),
                     pa.array(start, pa.int64()), pa.array(n), pa.array(crc, pa.int64()),
                     pa.array([task] * len(n), pa.int32()), pa.array(nth)],
                    ["_id", "piece", "start", "length", "ids_crc32", "task", "nth"])
    return run


class Pool:
    """Unpacked lengths with their counts."""

    def __init__(self, counts: dict[int, int]):
        self.count = {n: c for n, c in counts.items() if c}
        self.sizes = sorted(self.count)

    def at_most(self, gap: int) -> int:
        k = bisect_right(self.sizes, gap)
        return self.sizes[k - 1] if k else 0

    def take(self, n: int, many: int = 1) -> None:
        self.count[n] -= many
        if not self.count[n]:
            del self.sizes[bisect_right(self.sizes, n) - 1]

    def put(self, n: int) -> None:
        if not self.count.get(n):
            insort(self.sizes, n)
        self.count[n] = self.count.get(n, 0) + 1

    def best_two(self, gap: int, more_than: int) -> tuple[int, int] | None:
        """Two lengths whose sum is the largest in (more_than, gap]."""
        best, found = more_than, None
        lo, hi = 0, bisect_right(self.sizes, gap) - 1
        while lo <= hi and best < gap:
            a, b = self.sizes[lo], self.sizes[hi]
            if a + b > gap or (lo == hi and self.count[a] < 2):
                hi -= 1
            else:
                if a + b > best:
                    best, found = a + b, (a, b)
                lo += 1
        return found


def best_two_fit(counts: dict[int, int], size: int) -> list[tuple[list[int], int]]:
    """Bins as (lengths, how many bins of these), for so many pieces of each length."""
    pool, bins = Pool(counts), []
    while pool.sizes:
        chosen, gap = [], size
        while gap and (n := pool.at_most(gap)):
            pool.take(n)
            chosen.append(n)
            gap -= n
        held = Counter(chosen)                     # what choosing this bin needs at once
        if gap and pool.sizes:
            least = chosen[-1]
            two = pool.best_two(gap + least, least)
            if two:
                pool.put(chosen.pop())
                for n in two:
                    pool.take(n)
                    chosen.append(n)
        used = Counter(chosen)
        # the next bins are the same as long as each length lasts for it
        more = min(max(0, pool.count.get(n, 0) - max(held[n], u) + u) // u
                   for n, u in used.items())
        for n, u in used.items() if more else ():
            pool.take(n, u * more)
        bins.append((chosen, 1 + more))
    return bins


def places(bins: list[tuple[list[int], int]]) -> list[tuple[int, int, int, list[int], int]]:
    """(length, first rank, end rank, offsets, first sequence): the pieces of a length whose
    rank lies in the range share the places of a pattern, len(offsets) to a bin."""
    out, ranks, sequence = [], Counter(), 0
    for chosen, many in bins:
        offsets: dict[int, list[int]] = {}
        at = 0
        for n in chosen:
            offsets.setdefault(n, []).append(at)
            at += n
        for n, where in offsets.items():
            out.append((n, ranks[n], ranks[n] + many * len(where), where, sequence))
            ranks[n] += many * len(where)
        sequence += many
    return out


def _place(found, fields: int):
    """Sequence and offset of each piece from its length and rank."""

    def run(batches):
        length, first, _, offsets, sequence = found.value
        key = (length << 48) + first               # sorted
        each = np.array([len(x) for x in offsets], np.int64)
        begin = np.cumsum(each) - each
        flat = np.concatenate([np.array(x, np.int64) for x in offsets])
        for b in batches:
            n, rank = b.column(3).to_numpy(), b.column(fields).to_numpy()
            at = np.searchsorted(key, (n << 48) + rank, "right") - 1
            nth = rank - first[at]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in range(fields)]
                + [pa.array(sequence[at] + nth // each[at]),
                   pa.array(flat[begin[at] + nth % each[at]])],
                b.schema.names[:fields] + ["sequence_id", "offset"])
    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         size: int = SEQUENCE, end_id: int = END_ID, path: str | None = None) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    fields = "piece int, start bigint, length bigint, ids_crc32 bigint"
    pieces = materialize(
        docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_t"))
        .mapInArrow(_tokenize(path, size, end_id), f"_id {kind}, {fields}, task int, nth bigint"),
        "pieces")
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("many"))
    counts = {r["length"]: r["many"] for r in                # at most ``size`` rows
              by_task.groupBy("length").agg(F.sum("many").alias("many")).collect()}
    rows = sorted(places(best_two_fit(counts, size)), key=lambda r: r[:2]) or [(0, 0, 0, [0], 0)]
    columns = list(zip(*rows))
    found = spark.sparkContext.broadcast(
        tuple(x if k == 3 else np.array(x, np.int64) for k, x in enumerate(columns)))
    before = F.sum("many").over(Window.partitionBy("length").orderBy("task")) - F.col("many")
    ranked = (pieces.join(by_task.select("length", "task", before.alias("before")),
                          ["length", "task"])
              .select("_id", "piece", "start", "length", "ids_crc32",
                      (F.col("before") + F.col("nth")).alias("rank")))
    return (ranked.mapInArrow(_place(found, 5),
                              f"_id {kind}, {fields}, sequence_id bigint, offset bigint")
            .withColumnRenamed("_id", id_col))


def op5_best_two_fit(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


QUERIES = {"op5_best_two_fit": op5_best_two_fit}
ORACLE: dict[str, str] = {}
