"""Ranked lexical search by bag deduplication: every document ranked for each item.

Documents are restricted to the vocabulary of the items: what is left of one is its tf
vector over those terms and m, which its length alone decides. Documents that agree in
both score the same for every item, so they form a class: classes are found by a hash of
vector and m and verified on the bytes themselves. Each class is scored once against the
items, through the lists of items of its terms; a class then stands for its members in
ascending id, of which the ``k`` smallest can be among an item's first ``k``. All scores
are whole numbers, so ranks do not depend on the order of the additions.

Plan, for each block of items: one narrow scan writes id, length and vector of every
document; the sums over it (documents, terms, documents of a term) are one row for each
term of the block; classes are the rows of equal (hash, m, vector), of which each task
hands on at most ``k`` members, so a class that holds a third of all rows is no hot group;
each task ranks its classes and hands on at most ``k`` documents for an item.

Items come in blocks of at most ``BLOCK_ITEMS`` items and ``BLOCK_TERMS`` distinct (item,
term) pairs; the sizes are counted before a block is collected and the blocks made
smaller until all fit, down to a single item.

Defined results: null and empty texts have no terms; they count in no sum and rank
nowhere, items without terms get no rows; repeated rows of ``documents`` rank one by one;
null document ids rank after others of equal score; repeated (item, text) rows are one
item, an item id with several texts gets a ranking for each; without documents with terms
there are no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.tables import blocks, materialize, table
from auric.llm.text import ALNUM, Lookup, Words, runs, same_bytes, words

K = 10
LENGTH_FACTOR, LENGTH_PCT = 8, 75
BLOCK_ITEMS, BLOCK_TERMS = 4096, 1 << 20
CELLS = 1 << 21


class Vocabulary:
    """Distinct terms, to be found among the words of texts: by hash, then by bytes."""

    def __init__(self, terms: list[bytes]):
        self.terms = sorted(terms)
        raw = np.frombuffer(b" ".join(self.terms), np.uint8)
        w = words(raw, np.array([0, len(raw)]), ALNUM)
        self.data, self.start, self.size = raw, w.start, w.end - w.start
        self.by_hash = np.argsort(w.hash, kind="stable")
        self.keys, self.begin, self.many = np.unique(
            w.hash[self.by_hash], return_index=True, return_counts=True)
        self.lookup = Lookup(self.keys)

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(word, term) for the words of ``w`` that are terms."""
        at, key = self.lookup.find(w.hash)
        found = [(np.zeros(0, np.int64),) * 2]
        for other in range(int(self.many.max()) if len(at) else 0):   # terms of equal hash
            has = self.many[key] > other
            word, term = at[has], self.by_hash[self.begin[key[has]] + other]
            ok = self._same(w, word, term)
            found.append((word[ok], term[ok]))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _same(self, w: Words, word: np.ndarray, term: np.ndarray) -> np.ndarray:
        start, size = w.start[word], w.end[word] - w.start[word]
        same = size == self.size[term]
        at = np.flatnonzero(same)
        same[at] = same_bytes(w.kind.fold[w.data], start[at], self.data, self.start[term[at]], size[at])
        return same

def _item_terms(batches):
    """(i, item, terms, counts) of each item."""
    for b in batches:
        for lo, hi, data, off in runs(b.column(2)):
            w = words(data, off, ALNUM)
            terms, counts = [], []
            for r in range(hi - lo):
                seen = defaultdict(int)
                for j in range(int(w.first[r]), int(w.first[r + 1])):
                    seen[w.kind.fold[data[w.start[j]:w.end[j]]].tobytes()] += 1
                terms.append(list(seen))
                counts.append(list(seen.values()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                 pa.array(terms, pa.list_(pa.binary())), pa.array(counts, pa.list_(pa.int64()))],
                ["i", "item", "terms", "counts"])


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, most_items: int,
            most_terms: int):
    """The items, block by block, as lists of (item, terms, counts)."""
    kind = benchmark.schema[item_col].dataType.simpleString()
    items = (benchmark.select(F.col(item_col).alias("item"), F.col(text_col).cast("string").alias("t"))
             .distinct().select(F.xxhash64("item", "t").alias("i"), "item", "t"))
    items = materialize(items.mapInArrow(
        _item_terms, f"i bigint, item {kind}, terms array<binary>, counts array<bigint>")
        .where(F.size("terms") > 0), "item-terms")
    for rows in blocks(items, "i", (F.lit(1), most_items), (F.size("terms"), most_terms)):
        yield [(r["item"], r["terms"], r["counts"]) for r in rows]


def _vectors(vocabulary):
    """(doc_id, n, tf): a text's length in terms and its (term, tf) pairs as bytes."""

    def run(batches):
        v = vocabulary.value
        for b in batches:
            for lo, hi, data, off in runs(b.column(1)):
                w = words(data, off, ALNUM)
                word, term = v.find(w)
                key, tf = np.unique(w.row[word] * len(v.terms) + term, return_counts=True)
                row, term = np.divmod(key, len(v.terms))
                pairs = np.stack([term, tf], axis=1).astype("<u4")
                first = np.searchsorted(row, np.arange(hi - lo + 1)) * 8
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), pa.array(w.counts, pa.int64()),
                     pa.Array.from_buffers(pa.binary(), hi - lo, [
                         None, pa.py_buffer(first.astype(np.int32).tobytes()),
                         pa.py_buffer(pairs.tobytes())])],
                    ["doc_id", "n", "tf"])
    return run


def _pairs(column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, tf) of the pairs in a column of vectors."""
    column = column.cast(pa.large_binary())
    _, off, raw = column.buffers()
    off = np.frombuffer(off, np.int64)[column.offset:column.offset + len(column) + 1]
    flat = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    pairs = np.frombuffer(flat.tobytes(), "<u4").reshape(-1, 2).astype(np.int64)
    return np.repeat(np.arange(len(column)), np.diff(off) // 8), pairs[:, 0], pairs[:, 1]


def _document_counts(size: int):
    def run(batches):
        n = np.zeros(size, np.int64)
        for b in batches:
            n += np.bincount(_pairs(b.column(0))[1], minlength=size)
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["t", "df"])
    return run


class Scorer:
    """The items of a block: for each term its items and what one impact adds there."""

    def __init__(self, items: list[list[tuple[int, int]]], weight: np.ndarray, k: int):
        lists = defaultdict(list)
        for i, terms in enumerate(items):
            for t, count in terms:
                if weight[t] > 0:
                    lists[t].append((i, count * int(weight[t])))
        self.n, self.k = len(items), k
        self.lists = {t: tuple(np.array(x, np.int64).T) for t, x in lists.items()}

    def scores(self, row: np.ndarray, term: np.ndarray, tf: np.ndarray, m: np.ndarray
               ) -> np.ndarray:
        """int64[len(m), items]; rows count from 0."""
        out = np.zeros((len(m), self.n), np.int64)
        impact = (1_000_000_000 * tf) // (1000 * tf + LENGTH_FACTOR * m[row])
        order = np.argsort(term, kind="stable")
        row, impact = row[order], impact[order]
        found, begin = np.unique(term[order], return_index=True)
        for t, a, b in zip(found.tolist(), begin, np.append(begin[1:], len(order))):
            if t in self.lists:
                items, adds = self.lists[t]
                out[row[a:b, None], items] += impact[a:b, None] * adds
        return out

    def first(self, item, score, null, doc):
        """The ``k`` best of each item, ties by ascending id."""
        order = np.lexsort((doc, null, -score, item))
        item, score, null, doc = item[order], score[order], null[order], doc[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.k
        return item[keep], score[keep], null[keep], doc[keep]


def _rank(scorer):
    """(i, doc_id, score): of the classes of a task, each item's first documents."""

    def run(batches):
        s = scorer.value
        best = tuple(np.zeros(0, t) for t in (np.int64, np.int64, bool, np.int64))
        least = np.ones(s.n, np.int64)              # what a score must reach
        step = max(1, CELLS // max(1, s.n))
        for whole in batches:
            for at in range(0, whole.num_rows, step):
                b = whole.slice(at, step)
                got = s.scores(*_pairs(b.column(1)), b.column(0).to_numpy())
                bar = least
                if len(got) > s.k:
                    bar = np.maximum(bar, np.partition(got, len(got) - s.k, axis=0)[-s.k])
                row, item = np.nonzero(got >= bar)
                members = b.column(2)
                first = members.offsets.to_numpy() - members.offsets[0].as_py()
                ids = members.flatten().field(0)
                null = np.asarray(ids.is_null())
                doc = ids.fill_null(0).to_numpy()
                many = np.diff(first)[row]
                each = np.repeat(np.arange(len(row)), many)
                member = first[row][each] + np.arange(len(each)) - np.repeat(
                    np.cumsum(many) - many, many)
                best = s.first(*(np.concatenate(x) for x in zip(best, (
                    item[each], got[row, item][each], null[member], doc[member]))))
                at_item, first_of, there = np.unique(best[0], return_index=True,
                                                     return_counts=True)
                full = there >= s.k
                least[at_item[full]] = best[1][first_of[full] + s.k - 1]
        item, score, null, doc = best
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(doc, pa.int64(), mask=null),
             pa.array(score, pa.int64())], ["i", "doc_id", "score"])
    return run


def _search_block(docs: DataFrame, rows: list, kind: str, k: int) -> DataFrame:
    spark = docs.sparkSession
    vocabulary = Vocabulary(list({t for _, terms, _ in rows for t in map(bytes, terms)}))
    size = len(vocabulary.terms)
    place = {t: i for i, t in enumerate(vocabulary.terms)}
    sent = spark.sparkContext.broadcast(vocabulary)
    vectors = materialize(docs.mapInArrow(_vectors(sent), "doc_id bigint, n bigint, tf binary")
                          .where("n > 0"), "vectors")
    n, length = vectors.agg(F.count(F.lit(1)), F.sum("n")).first()
    schema = f"item_id {kind}, rank int, doc_id bigint, score bigint"
    if not n:
        return spark.createDataFrame([], schema)
    weight = np.zeros(size, np.int64)
    for r in (vectors.select("tf").mapInArrow(_document_counts(size), "t bigint, df bigint")
              .groupBy("t").agg(F.sum("df").alias("df")).collect()):     # the block's terms
        weight[r["t"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1)))
    m = F.expr(f"{100 - LENGTH_PCT} + ({LENGTH_PCT} * n * {n}L) div {length}L")
    same = ["hash", "m", "tf"]
    classes = (vectors.where(F.length("tf") > 0).withColumn("m", m)
               .select(F.xxhash64("tf", "m").alias("hash"), "m", "tf", "doc_id")
               .withColumn("nth", F.row_number().over(
                   Window.partitionBy(*same).orderBy(F.col("doc_id").asc_nulls_last())))
               .where(F.col("nth") <= k)
               .groupBy(*same).agg(F.collect_list(F.struct("doc_id")).alias("members"))
               .select("m", "tf", "members"))
    items = [[(place[bytes(t)], c) for t, c in zip(terms, counts)] for _, terms, counts in rows]
    scorer = spark.sparkContext.broadcast(Scorer(items, weight, k))
    names = spark.createDataFrame([(i, r[0]) for i, r in enumerate(rows)],
                                  f"i bigint, item_id {kind}")
    order = Window.partitionBy("i").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return (classes.mapInArrow(_rank(scorer), "i bigint, doc_id bigint, score bigint")
            .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .join(names, "i").select("item_id", "rank", "doc_id", "score"))


def ranked(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", k: int = K,
           block_items: int = BLOCK_ITEMS, block_terms: int = BLOCK_TERMS) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's ``k`` documents of the highest score."""
    kind = benchmark.schema[item_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                        F.col(text_col).cast("string").alias("t"))
    parts = [_search_block(texts, rows, kind, k) for rows in
             _blocks(benchmark, item_col, item_text_col, block_items, block_terms)]
    if len(parts) > 1:
        parts = [materialize(p, "ranked") for p in parts]
    out = parts[0] if parts else docs.sparkSession.createDataFrame(
        [], f"item_id {kind}, rank int, doc_id bigint, score bigint")
    for p in parts[1:]:
        out = out.union(p)
    return out


def op13_lexical_search(spark, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {"op13_lexical_search": op13_lexical_search}
_FOLDED = ("translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")
ORACLE = {"op13_lexical_search": rf"""
WITH tokens AS (
  SELECT doc_id, unnest(regexp_extract_all({_FOLDED.format('text')},
                                           '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
  FROM documents
), tfs AS (
  SELECT doc_id, term, count(*) AS tf FROM tokens GROUP BY ALL
), lengths AS (
  SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tfs GROUP BY doc_id
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), ms AS (
  SELECT doc_id, 25 + (75 * n * docs) // terms AS m FROM lengths, totals
), weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE)
                                    / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, docs
), wanted AS (
  SELECT item_id, term, count(*) AS c
  FROM (SELECT item_id, unnest(regexp_extract_all({_FOLDED.format('text')},
                                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
        FROM benchmark) GROUP BY ALL
), scored AS (
  SELECT item_id, doc_id,
         CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN ms USING (doc_id)
  GROUP BY ALL
), ordered AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)
                       AS INTEGER) AS rank, doc_id, score
  FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ordered WHERE rank <= 10
"""}
