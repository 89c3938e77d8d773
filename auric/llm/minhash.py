"""Near-duplicates by DartMinHash.

A document is a weighted set: its word shingles with the number of times each
occurs. Darts fall on every element's weight as a unit-rate Poisson process over
(weight, rank), drawn from hashes of (element, unit of weight, dart number), so the
darts of an element are the same in every document that holds it. Only ranks
below ``theta`` are drawn, chosen so that about ``k ln k + 2 k`` darts fall on the
whole document: long texts draw almost nothing per element, which is what makes
the sketch fast. Each dart names one of ``k`` coordinates; the earliest dart of a
coordinate is its value (documents with an empty coordinate are drawn again with
twice the range). Two documents agree in a coordinate with probability equal to
their weighted Jaccard similarity. ``bands`` x ``rows`` coordinates are joined.

Plan:

1. One scan gives each row a key of its text, a digest of its word sequence and its
   band hashes. Rows with the same words are one node (aggregated before
   the shuffle, however many copies there are).
2. In each bucket of a band every node is paired with one node of it only, its pivot, so
   a bucket of n nodes gives n - 1 pairs. The pairs are verified exactly
   on their weighted sets; verified links are merged into components.
3. Nodes that shared buckets connect form a cluster. Where a cluster still holds
   several components, every pair of nodes from different components whose weights
   allow the similarity is compared, block by block in the memory of a task. Only
   pairs of components come out, so a link between two different texts that share a
   bucket is found or lies within a component, and no pairs are listed. This step's
   time grows with the square of such a cluster, less its largest component's own.

``min_similarity`` 0.8 with 32 bands of 5 rows misses a pair at 0.8 with
probability 3e-6. Intermediate tables are written to the shared checkpoint
folder; nothing of the documents goes through the driver, and of the joins only a row
for each cluster that holds several components (and its blocks) may be broadcast: the
others are ``shuffled_join``, as Spark would take exploded bands for small.

Defined results: a text of fewer words than a shingle is one shingle of all its
words; rows without words (null, empty, punctuation only) are one class, as are
all rows whose words are equal; null ids are classed by their texts, and
``class_id`` is the smallest id of the class that is not null (null if there is
none); repeated rows are returned as often as they occur; other columns are
ignored by ``near_duplicates`` and kept by ``one_of_each``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.tables import materialize, shuffled_join, table
from auric.llm.text import _P, ALNUM, U, Words, mix, runs, seeded, shingles, words

SHINGLE = 5
MIN_SIMILARITY = 0.8
BANDS, ROWS = 32, 5
DARTS_AT_ONCE = 1 << 20
BLOCK_NODES, BLOCK_CELLS, BLOCK_COLUMNS = 256, 1 << 20, 4096


def weighted_cells(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(cell, row): one cell for each unit of an element's weight, that is for the
    j-th occurrence of a shingle in a row. Sorted by row."""
    h, at = shingles(w, size)
    row = w.row[at] if len(at) else np.zeros(0, np.int64)
    short = np.flatnonzero((w.counts > 0) & (w.counts < size))
    if len(short):
        whole = []
        for r in short.tolist():
            acc = U(0)
            with np.errstate(over="ignore"):
                for x in w.hash[w.first[r]:w.first[r + 1]]:
                    acc = acc * _P + x
            whole.append(acc)
        h = np.concatenate([h, mix(np.array(whole, U) + U(size))])
        row = np.concatenate([row, short])
    key = h ^ seeded(row.astype(U), 11)
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    begin = np.flatnonzero(new)
    nth = np.zeros(len(key), np.int64)
    nth[order] = np.arange(len(key)) - np.repeat(begin, np.diff(np.append(begin, len(key))))
    cell = np.where(nth == 0, h, mix(h + seeded(nth.astype(U), 13)))
    by_row = np.argsort(row, kind="stable")
    return cell[by_row], row[by_row]


def _darts(cell: np.ndarray, row: np.ndarray, theta: np.ndarray, k: int, n: int) -> np.ndarray:
    """Value of each coordinate of n rows (0: no dart); rows count from 0."""
    earliest = np.full(n * k, np.inf)
    thrown = []
    rank = np.zeros(len(cell))
    m = 0
    while len(cell):
        h = seeded(cell, 17 + m)
        u = ((h >> U(11)).astype(np.float64) + 0.5) * 2.0 ** -53
        rank = rank - np.log(u)
        on = rank < theta[row]
        cell, row, rank, h = cell[on], row[on], rank[on], mix(h[on] + U(1))
        slot = row * k + ((h >> U(32)) * U(k) >> U(32)).astype(np.int64)
        np.minimum.at(earliest, slot, rank)
        thrown.append((slot, rank, h))
        m += 1
    value = np.zeros(n * k, U)
    for slot, rank, h in thrown:
        first = rank == earliest[slot]
        value[slot[first]] = h[first] | U(1)
    return value.reshape(n, k)


def signatures(cell: np.ndarray, row: np.ndarray, n: int, k: int) -> np.ndarray:
    """uint64[n, k]; rows without cells stay 0."""
    out = np.zeros((n, k), U)
    weight = np.bincount(row, minlength=n)
    first = np.concatenate([[0], np.cumsum(weight)])
    darts = k * (math.log(k) + 2)
    at_once = max(1, int(DARTS_AT_ONCE / darts))
    rest = np.flatnonzero(weight)
    reach = 1.0
    while len(rest):
        again = []
        for lo in range(0, len(rest), at_once):
            part = rest[lo:lo + at_once]
            many = weight[part]
            mine = np.repeat(np.arange(len(part)), many)
            at = np.arange(len(mine)) + np.repeat(first[part] - (np.cumsum(many) - many), many)
            got = _darts(cell[at], mine, reach * darts / many, k, len(part))
            out[part] = got
            again.append(part[(got == 0).any(axis=1)])
        rest = np.concatenate(again)
        reach *= 2
    return out


def band_hashes(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    part = sig.reshape(len(sig), bands, rows)
    acc = np.broadcast_to(seeded(np.arange(bands).astype(U), 19), part.shape[:2])
    for r in range(rows):
        acc = mix(acc * _P + part[:, :, r])
    return acc.view(np.int64)


def fingerprints(w: Words) -> pa.Array:
    """Digest of the word sequence of each row: 16 bytes of SHA-256."""
    first = w.first.tolist()
    return pa.array([hashlib.sha256(w.joined(a, b) if b > a else b"").digest()[:16]
                     for a, b in zip(first, first[1:])], pa.binary())


def _int_lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values))


def _text_key(text_col: str):
    return F.unhex(F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit(""))))


def _sketch(size: int, bands: int, rows: int):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in runs(b.column(2)):
                w = words(data, off, ALNUM)
                cell, row = weighted_cells(w, size)
                sig = signatures(cell, row, hi - lo, bands * rows)
                weight = np.bincount(row, minlength=hi - lo)
                first = np.concatenate([[0], np.cumsum(np.where(weight > 0, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), b.column(1).slice(lo, hi - lo),
                     fingerprints(w), pa.array(weight, pa.int64()),
                     _int_lists(band_hashes(sig[weight > 0], bands, rows).ravel(), first)],
                    ["_id", "key", "node", "weight", "bands"])
    return run


def _cells(size: int):
    def run(batches):
        for b in batches:
            for lo, hi, data, off in runs(b.column(1)):
                cell, row = weighted_cells(words(data, off, ALNUM), size)
                first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=hi - lo))])
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, hi - lo), _int_lists(cell.view(np.int64), first)],
                    ["n", "cells"])
    return run


def _linked(least: float):
    """Pairs of components with a link between a row of side 0 and one of side 1 (or
    another of side 0 where there is no side 1)."""

    def run(group: pa.Table) -> pa.Table:
        side = group.column("side").to_numpy()
        comp = group.column("c").to_numpy()
        lists = group.column("cells").combine_chunks()
        weight = np.diff(lists.offsets.to_numpy())
        owner = np.repeat(np.arange(len(side)), weight)
        place, column = np.unique(lists.flatten().to_numpy(), return_inverse=True)
        x = np.flatnonzero(side == 0)
        y = np.flatnonzero(side == 1) if (side == 1).any() else x
        row_x, row_y = np.full(len(side), -1), np.full(len(side), -1)
        row_x[x], row_y[y] = np.arange(len(x)), np.arange(len(y))
        both = np.zeros((len(x), len(y)), np.float32)
        order = np.argsort(column, kind="stable")
        owner, column = owner[order], column[order]
        for lo in range(0, len(place), BLOCK_COLUMNS):
            a, b = np.searchsorted(column, [lo, lo + BLOCK_COLUMNS])
            who, at = owner[a:b], column[a:b] - lo
            dense = []
            for rows, n in ((row_x, len(x)), (row_y, len(y))):
                here = rows[who] >= 0
                part = np.zeros((n, BLOCK_COLUMNS), np.float32)
                part[rows[who[here]], at[here]] = 1
                dense.append(part)
            both += dense[0] @ dense[1].T
        union = weight[x][:, None] + weight[y][None, :] - both
        near = (both >= least * union - 1e-6) & (comp[x][:, None] != comp[y][None, :])
        i, j = np.nonzero(near)
        found = np.unique(np.sort(np.stack([comp[x[i]], comp[y[j]]], axis=1), axis=1), axis=0)
        return pa.table({"a": pa.array(found[:, 0], pa.int64()),
                         "b": pa.array(found[:, 1], pa.int64())})
    return run


def components(edges: DataFrame) -> DataFrame:
    """(n, c): the smallest node c of the component of each node n of ``edges``
    (a, b). Smallest label of the neighbours, then of the label itself, until
    nothing changes; each round is a table in the shared folder."""
    both = materialize(edges.select("a", "b").union(edges.select("b", "a")), "edges")
    labels = materialize(both.groupBy(F.col("a").alias("n"))
                         .agg(F.least(F.min("b"), F.first("a")).alias("c")), "labels")
    while True:
        near = (shuffled_join(both, labels.withColumnRenamed("n", "b"), "b")
                .groupBy(F.col("a").alias("n")).agg(F.min("c").alias("m")))
        step = shuffled_join(labels, near, "n").select("n", F.col("c").alias("old"),
                                                       F.least("c", "m").alias("c"))
        jump = labels.select(F.col("n").alias("c"), F.col("c").alias("further"))
        new = materialize(shuffled_join(step, jump, "c")
                          .select("n", "old", F.least("c", "further").alias("c")), "labels")
        done = new.where("c <> old").isEmpty()
        labels = new.select("n", "c")
        if done:
            return labels


class NearDuplicates:
    """The steps of the plan over one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, size: int = SHINGLE,
                 min_similarity: float = MIN_SIMILARITY, bands: int = BANDS, rows: int = ROWS):
        self.size, self.least = size, min_similarity
        kind = docs.schema[id_col].dataType.simpleString()
        self.texts = docs.select(F.col(id_col).alias("_id"), _text_key(text_col).alias("key"),
                                 F.col(text_col).cast("string").alias("_t"))
        self.rows = materialize(self.texts.mapInArrow(
            _sketch(size, bands, rows),
            f"_id {kind}, key binary, node binary, weight bigint, bands array<bigint>"), "rows")
        self.nodes = materialize(
            self.rows.groupBy("node")
            .agg(F.min("_id").alias("first_id"), F.count(F.lit(1)).alias("docs"),
                 F.min(F.struct("_id", "key")).alias("rep"), F.first("weight").alias("weight"),
                 F.first("bands").alias("bands"))
            .withColumn("n", F.monotonically_increasing_id()), "nodes")
        self.buckets = self._buckets()

    def _buckets(self) -> DataFrame:
        """(bucket, n, pivot) for buckets of two nodes or more. The pivot is the node that
        meets the most others over all its buckets, so that the buckets of one group of
        copies mostly have the same one and a node few different ones."""
        each = self.nodes.select("n", F.explode("bands").alias("bucket"))
        shared = (each.groupBy("bucket").agg(F.count(F.lit(1)).alias("many"))
                  .where("many > 1"))
        met = F.sum("many").over(Window.partitionBy("n"))     # a node has ``bands`` buckets
        ranked = materialize(shuffled_join(each, shared, "bucket").select(
            "bucket", "n", F.struct(met.alias("met"), (-F.col("n")).alias("n")).alias("place")),
            "ranked")
        pivots = ranked.groupBy("bucket").agg((-F.max("place")["n"]).alias("pivot"))
        return materialize(shuffled_join(ranked.select("bucket", "n"), pivots, "bucket"),
                           "buckets")

    def _star(self) -> DataFrame:
        """(a, b): each node of a shared bucket with the bucket's pivot."""
        return materialize(self.buckets.where("n <> pivot")
                           .select(F.col("n").alias("a"), F.col("pivot").alias("b"))
                           .distinct(), "star")

    @staticmethod
    def _slim(edges: DataFrame) -> DataFrame:
        """Edges that connect the same nodes as those of a star (a: a node, b: one of its at
        most ``bands`` pivots): each node with one of its pivots, its other pivots with that."""
        one = F.min("b").over(Window.partitionBy("a"))
        each = edges.select("a", "b", one.alias("c"))
        return (each.select("a", F.col("c").alias("b"))
                .union(each.where("b <> c").select("b", "c")).distinct())

    def _weighted_sets(self, star: DataFrame) -> DataFrame:
        """(n, cells) of all nodes of shared buckets, from the whole texts."""
        wanted = star.select(F.col("a").alias("n")).union(star.select("b")).distinct()
        reps = shuffled_join(self.nodes.select("n", F.col("rep._id").alias("rid"),
                                               F.col("rep.key").alias("rkey")), wanted, "n")
        texts = (shuffled_join(self.texts, reps, (F.col("key") == F.col("rkey"))
                               & F.col("_id").eqNullSafe(F.col("rid")))
                 .select("n", "_t"))
        return materialize(texts.mapInArrow(_cells(self.size), "n bigint, cells array<bigint>")
                           .dropDuplicates(["n"]), "cells")

    def classes(self) -> DataFrame:
        """(n, c) for the nodes that share a bucket."""
        star = self._star()
        cells = self._weighted_sets(star)
        one = cells.select(F.col("n").alias("a"), F.col("cells").alias("x"))
        two = cells.select(F.col("n").alias("b"), F.col("cells").alias("y"))
        both = F.size(F.array_intersect("x", "y"))
        total = F.size("x") + F.size("y")
        links = materialize(
            shuffled_join(shuffled_join(star, one, "a"), two, "b")
            .select("a", "b", total.alias("total"), both.alias("both"))
            .where(F.col("both") >= self.least * (F.col("total") - F.col("both")) - 1e-9)
            .select("a", "b"), "links")
        members = materialize(
            shuffled_join(components(self._slim(star)).withColumnRenamed("c", "s"),
                          components(self._slim(links)), "n", "left")
            .withColumn("c", F.coalesce("c", "n")), "members")
        more = materialize(self._between(members, cells), "more")
        # a component stays one by its edges to its smallest node
        joined = components(members.where("n <> c")
                            .select(F.col("n").alias("a"), F.col("c").alias("b"))
                            .union(more))
        return (shuffled_join(members.select("n", F.col("c").alias("old")), joined, "n", "left")
                .select("n", F.coalesce("c", "old").alias("c")))

    def _between(self, members: DataFrame, cells: DataFrame) -> DataFrame:
        """(a, b): components of one cluster that have a link between them.

        A cluster holds all nodes that shared buckets connect. Where it has several
        components, its nodes are dealt into blocks by weight and hash, and blocks
        whose weights allow the similarity are compared in pairs, each in a task's
        memory; only pairs of components come out. The cluster's largest component
        is not compared with itself."""
        count = members.groupBy("s", "c").agg(F.count(F.lit(1)).alias("many"))
        mixed = (count.groupBy("s").agg(F.count(F.lit(1)).alias("parts"),
                                        F.max(F.struct("many", "c")).alias("top"))
                 .where("parts > 1").select("s", F.col("top.c").alias("top")))
        weight = F.size("cells")
        step = 1 / self.least if 0 < self.least < 1 else 2.0
        # mixed, sizes and blocks may be broadcast: joined by shuffles, a hot cluster's
        # cells would lie in one task
        own = (shuffled_join(members.join(mixed, "s"), cells, "n")
               .select("s", "n", "c", (F.col("c") == F.col("top")).alias("main"),
                       F.floor(F.log(weight) / math.log(step)).cast("int").alias("size"),
                       weight.alias("weight"), "cells"))
        key = ["s", "main", "size"]
        sizes = (own.groupBy(*key)
                 .agg(F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK_NODES,
                                        F.sum("weight") / BLOCK_CELLS)).cast("int").alias("parts")))
        own = materialize(own.join(sizes, key).withColumn(
            "part", F.pmod(F.xxhash64("n"), F.col("parts")).cast("int")).drop("parts", "weight"),
            "own")
        blocks = sizes.select(*key, F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
        block = [*key, "part"]
        x = blocks.select("s", F.struct(*block[1:]).alias("x"))
        y = blocks.select("s", F.struct(*block[1:]).alias("y"))
        pairs = (x.join(y, "s")
                 .where((F.col("x") <= F.col("y")) & ~(F.col("x.main") & F.col("y.main"))
                        & (F.abs(F.col("x.size") - F.col("y.size")) <= 1))
                 .withColumn("pair", F.xxhash64("s", "x", "y")))
        sides = [pairs.select("pair", "s", f"{side}.*", F.lit(k).alias("side"))
                 for k, side in enumerate("xy")]
        sides[1] = pairs.where("x <> y").select("pair", "s", "y.*", F.lit(1).alias("side"))
        return (shuffled_join(sides[0].union(sides[1]), own, block)
                .select("pair", "side", "c", "cells")
                .groupBy("pair").applyInArrow(_linked(self.least), "a bigint, b bigint")
                .distinct())

    def labelled(self) -> DataFrame:
        """(node, class_id, class_docs, keep): ``keep`` is the key of the one text
        that stands for the class, on one node of each class."""
        every = (shuffled_join(self.nodes.select("n", "node", "first_id", "docs", "rep"),
                               self.classes(), "n", "left").withColumn("c", F.coalesce("c", "n")))
        every = materialize(every, "labelled")
        total = every.groupBy("c").agg(F.min("first_id").alias("class_id"),
                                       F.sum("docs").alias("class_docs"),
                                       F.min(F.struct("rep", "n")).alias("best"))
        return shuffled_join(every, total, "c").select(
            "node", "class_id", "class_docs",
            F.when(F.col("best.n") == F.col("n"), F.col("rep")).alias("keep"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    **options) -> DataFrame:
    """One row per document: id, class_id, class_docs (rows in its class)."""
    nd = NearDuplicates(docs, id_col, text_col, **options)
    return (shuffled_join(nd.rows.select("_id", "node"), nd.labelled(), "node")
            .select(F.col("_id").alias(id_col), "class_id", "class_docs"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                **options) -> DataFrame:
    """One row of ``docs``, all columns, for each class."""
    nd = NearDuplicates(docs, id_col, text_col, **options)
    keep = (nd.labelled().where("keep is not null")
            .select(F.col("keep._id").alias("rid"), F.col("keep.key").alias("rkey")))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                        F.col(id_col).alias("_id"), _text_key(text_col).alias("key"))
    return (shuffled_join(whole, keep, (F.col("key") == F.col("rkey"))
                          & F.col("_id").eqNullSafe(F.col("rid")))
            .dropDuplicates(["_id", "key"]).select("row.*"))


def op10_dartminhash(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op10_dartminhash": op10_dartminhash}
ORACLE: dict[str, str] = {}
