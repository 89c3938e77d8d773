"""Filter interaction audit: which of five filters removes what, in every order.

The files of a table are processed as available-now micro-batches. A micro-batch turns
each document into the four conditions its text alone decides (A-D), a digest of the
text and its part; within a task, only the smallest id of a text stays a candidate, the
other rows of that text are already summed as failing E (so a text that a third of all
rows share sends one candidate a task). The keyed text state holds for every text the
smallest id seen so far and the counts of the rows that carry it. When a smaller id
arrives, in whatever file, the counts booked for the earlier one are retracted from its
part's counter without E and booked again with E. The counters, one for each (part,
conditions failed, labels), are written for each batch under its number, so a batch run
again after a failure replaces its own; their sum is exact whatever the order of files.
At most parts x 128 counters are left, from which all 120 orders follow.

State is kept in ``buckets`` groups of texts (about ``TEXTS`` each): a group's texts are
merged at once. A batch rewrites the groups it touches, so there are ``BATCHES`` batches
of equal numbers of files however large the table is. Where it is kept is the session's
choice (``spark.sql.streaming.stateStore.providerClass``; RocksDB in ``CLUSTER_CONF``).

Conditions: A under 200 words; B 100 * distinct words < 50 * words; C 100 * [A-Z] > 3 *
code points; D holds one of # $ % & * |; E the text is that of a smaller id, table-wide.

Defined results: a null text is the empty text; a null part is the empty string; rows of
the smallest id of a text all pass E, also if that id is repeated; rows with a null id
pass E and make no other row fail it; an id counts as good (toxic) if any of its labels
says so; an empty table gives no rows; other columns are ignored whatever their names.
"""

from __future__ import annotations

import json
import math
from itertools import permutations

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm.tables import materialize, table
from auric.session import scratch_path

LETTERS = "ABCDE"
E_BIT, GOOD, TOXIC = 16, 32, 64
BATCHES = 4
TEXTS = 2000
ROWS_AT_ONCE = 200_000

_FACTS = "bucket bigint, digest binary, id bigint, part string, bits int, n bigint"
_DELTAS = "part string, bits int, n bigint"


def conditions(text: Column) -> Column:
    """The bits of A-D that a text fails."""
    words = F.filter(F.split(text, r"[ \t\n\x0B\f\r]+"), lambda w: w != "")
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    fails = [F.size(words) < 200,
             100 * F.size(F.array_distinct(words)).cast("bigint") < 50 * F.size(words).cast("bigint"),
             100 * capitals.cast("bigint") > 3 * F.length(text).cast("bigint"),
             text.rlike(r"[#$%&*|]")]
    return sum((f.cast("int") * (1 << k) for k, f in enumerate(fails)), F.lit(0))


def label_bits(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(lid, marks): one row for each labelled id that is good or toxic."""
    marks = (F.coalesce(F.max((F.col("quality") == 1).cast("int")), F.lit(0)) * GOOD
             + F.coalesce(F.max((F.col("toxic") == 1).cast("int")), F.lit(0)) * TOXIC)
    return (labels.where(F.col(id_col).isNotNull())
            .groupBy(F.col(id_col).cast("bigint").alias("lid")).agg(marks.alias("marks"))
            .where("marks > 0"))


def _summed(rows: pd.DataFrame, by: list[str]) -> pd.DataFrame:
    return rows.groupby(by, as_index=False, dropna=False, sort=False)["n"].sum()


def _combine(batches):
    """The rows of a task, by text: those of its smallest id as they are, all others
    summed as failing E (their ids no longer matter)."""
    held, many = [], 0
    for b in batches:
        held.append(pd.DataFrame({
            "bucket": b.column(0).to_numpy(), "digest": b.column(1).to_pylist(),
            "id": b.column(2).to_pandas(integer_object_nulls=True),
            "part": b.column(3).to_pylist(), "bits": b.column(4).to_numpy(),
            "n": b.column(5).to_numpy()}))
        many += b.num_rows
        if many >= ROWS_AT_ONCE:
            yield _batch(_least(pd.concat(held, ignore_index=True)))
            held, many = [], 0
    if many:
        yield _batch(_least(pd.concat(held, ignore_index=True)))


def _batch(rows: pd.DataFrame) -> pa.RecordBatch:
    ids = [None if x is None or x != x else int(x) for x in rows["id"]]
    return pa.RecordBatch.from_arrays(
        [pa.array(rows["bucket"], pa.int64()), pa.array(rows["digest"], pa.binary()),
         pa.array(ids, pa.int64()), pa.array(rows["part"], pa.string()),
         pa.array(rows["bits"], pa.int32()), pa.array(rows["n"], pa.int64())],
        ["bucket", "digest", "id", "part", "bits", "n"])


def _least(rows: pd.DataFrame) -> pd.DataFrame:
    known = rows["id"].notna().to_numpy()
    settled, open_ = rows[~known], rows[known]
    ids = open_["id"].astype("int64")
    later = (ids > ids.groupby(open_["digest"]).transform("min")).to_numpy()
    failed = open_[later].assign(id=None)
    failed["bits"] = failed["bits"] | E_BIT
    settled = pd.concat([settled.astype({"id": object}), failed])
    # what is settled may go to any bucket
    settled = _summed(settled, ["part", "bits"]).assign(
        bucket=int(rows["bucket"].iloc[0]), digest=None, id=None)
    kept = _summed(open_[~later], ["bucket", "digest", "id", "part", "bits"])
    return pd.concat([kept.astype({"id": object}), settled.astype({"id": object})],
                     ignore_index=True)


_STATE = ["digest", "id", "part", "bits", "n"]


def _merge(key, frames, state):
    """Texts of one bucket: new rows against the smallest ids so far."""
    new = pd.concat(list(frames), ignore_index=True)
    known = new["id"].notna()
    out = [new.loc[~known, ["part", "bits", "n"]]]
    new = new.loc[known, _STATE].astype({"id": "int64"}).assign(seen=False)
    if state.exists:
        old = pa.ipc.open_stream(state.get[0]).read_pandas()[_STATE].assign(seen=True)
        new = pd.concat([old, new], ignore_index=True)
    if len(new):
        first = new["id"] == new.groupby("digest")["id"].transform("min")
        seen = new["seen"]
        fails = lambda rows: rows.assign(bits=rows["bits"] | E_BIT)
        out += [new[first & ~seen], fails(new[~first & ~seen]),
                new[~first & seen].assign(n=-new["n"]), fails(new[~first & seen])]
        rest = _summed(new[first], _STATE[:-1])
        held = pa.Table.from_pandas(rest[_STATE], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held.schema) as writer:
            writer.write_table(held)
        state.update((sink.getvalue().to_pybytes(),))
    yield _summed(pd.concat([x[["part", "bits", "n"]] for x in out]), ["part", "bits"])


def counters(spark: SparkSession, path: str, labels: DataFrame, id_col: str = "doc_id",
             text_col: str = "text", part_col: str = "lang", batches: int = BATCHES,
             buckets: int | None = None) -> DataFrame:
    """(part, bits, n) of the documents below ``path`` (Parquet files): bits 0-4 are the
    conditions A-E that fail, then good and toxic."""
    docs = spark.read.parquet(path)
    buckets = buckets or max(1, math.ceil(docs.count() / TEXTS))       # from the footers
    files = max(1, math.ceil(len(docs.inputFiles()) / batches))
    marks = materialize(label_bits(labels, id_col), "label-bits")
    stem = path.rstrip("/")
    either = f"{stem[:-1]}[{stem[-1]}]"     # a pattern, as a stream may then read one file
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    facts = (spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", files).parquet(either)
             .select(F.col(id_col).cast("bigint").alias("id"), text.alias("t"),
                     F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"))
             .select("id", "part", F.unhex(F.sha2("t", 256)).alias("digest"),
                     conditions(F.col("t")).alias("bits"))
             .join(marks, F.col("id") == F.col("lid"), "left")
             .select(F.pmod(F.xxhash64("digest"), F.lit(buckets)).alias("bucket"), "digest",
                     "id", "part", (F.col("bits") + F.coalesce("marks", F.lit(0))).alias("bits"),
                     F.lit(1).cast("bigint").alias("n"))
             .mapInArrow(_combine, _FACTS))
    deltas = facts.groupBy("bucket").applyInPandasWithState(
        _merge, _DELTAS, "held binary", "update", "NoTimeout")
    out = scratch_path(spark, "filter-counters")

    def book(changes: DataFrame, number: int) -> None:
        (changes.groupBy("part", "bits").agg(F.sum("n").alias("n"))
         .write.mode("overwrite").parquet(f"{out}/batch={number}"))

    query = (deltas.writeStream.outputMode("update").foreachBatch(book)
             .option("checkpointLocation", scratch_path(spark, "filter-audit-state"))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    spark.createDataFrame([], _DELTAS).write.mode("overwrite").parquet(f"{out}/batch=-1")
    return (spark.read.schema(f"{_DELTAS}, batch int").parquet(out).groupBy("part", "bits")
            .agg(F.sum("n").alias("n")).where("n <> 0"))


def _orders() -> list[dict]:
    return [{"filter_order": "".join(p), "step": k + 1, "letter": p[k],
             "bit": 1 << LETTERS.index(p[k]),
             "before": sum(1 << LETTERS.index(x) for x in p[:k])}
            for p in permutations(LETTERS) for k in range(len(LETTERS))]


def interactions(counted: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step."""
    steps = F.from_json(F.lit(json.dumps(_orders())),
                        "array<struct<filter_order:string,step:int,letter:string,bit:int,before:int>>")
    rows = counted.select("part", "bits", "n", F.explode(steps).alias("s")).select(
        "part", "bits", "n", "s.*")
    bits, bit = F.col("bits"), F.col("bit")
    fails = bits.bitwiseAND(bit) > 0
    there = bits.bitwiseAND(F.col("before")) == 0
    total = lambda when: F.sum(F.when(when, F.col("n")).otherwise(0)).cast("bigint")
    lost = there & fails
    each = rows.groupBy("part", "filter_order", "step", "letter").agg(
        total(there & ~fails).alias("kept"), total(lost).alias("removed"),
        total(fails & ~there).alias("redundant"),
        total(bits.bitwiseAND(E_BIT * 2 - 1) == bit).alias("unique_fails"),
        total(lost & (bits.bitwiseAND(GOOD) > 0)).alias("good_lost"),
        total(lost & (bits.bitwiseAND(TOXIC) > 0)).alias("toxic_lost"))
    whole = each.groupBy("part", "letter").agg(F.sum("removed").alias("shapley"))
    return each.join(whole, ["part", "letter"]).drop("letter")


def audit(spark: SparkSession, path: str, labels: DataFrame, **options) -> DataFrame:
    return interactions(counters(spark, path, labels, **options))


def op11_filter_audit(spark, sf_dir: str) -> DataFrame:
    return audit(spark, f"{sf_dir.rstrip('/')}/documents.parquet", table(spark, sf_dir, "labels"))


QUERIES = {"op11_filter_audit": op11_filter_audit}
ORACLE = {"op11_filter_audit": r"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good,
         max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), first_ids AS (
  SELECT t, min(doc_id) AS least FROM texts GROUP BY t
), facts AS (
  SELECT x.part, coalesce(m.good, 0) AS good, coalesce(m.toxic, 0) AS toxic,
         (CASE WHEN len(w) < 200 THEN 1 ELSE 0 END)
         + (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 2 ELSE 0 END)
         + (CASE WHEN 100 * length(regexp_replace(x.t, '[^A-Z]', '', 'g')) > 3 * length(x.t)
            THEN 4 ELSE 0 END)
         + (CASE WHEN regexp_matches(x.t, '[#$%&*|]') THEN 8 ELSE 0 END)
         + (CASE WHEN x.doc_id > f.least THEN 16 ELSE 0 END) AS bits
  FROM texts x JOIN first_ids f ON x.t = f.t LEFT JOIN marks m ON m.doc_id = x.doc_id
), counted AS (
  SELECT part, bits, good, toxic, count(*) AS n FROM facts GROUP BY ALL
), letters(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)
), orders AS (
  SELECT a.l || b.l || c.l || d.l || e.l AS filter_order,
         [a.b, b.b, c.b, d.b, e.b] AS bs
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE a.b + b.b + c.b + d.b + e.b = 31 AND (a.b | b.b | c.b | d.b | e.b) = 31
), steps AS (
  SELECT filter_order, CAST(s AS INTEGER) AS step, bs[s] AS bit,
         CAST(coalesce(list_sum(bs[1:s - 1]), 0) AS INTEGER) AS before
  FROM orders, range(1, 6) r(s)
), each AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN bits & before = 0 AND bits & bit = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN bits & before = 0 AND bits & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN bits & before > 0 AND bits & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN bits = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN bits & before = 0 AND bits & bit > 0 THEN n * good ELSE 0 END) AS good_lost,
         sum(CASE WHEN bits & before = 0 AND bits & bit > 0 THEN n * toxic ELSE 0 END) AS toxic_lost
  FROM counted, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM each
"""}
