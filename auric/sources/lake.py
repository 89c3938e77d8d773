"""Versioned Parquet tables: ``<root>/<layer>/<table>/v=<n>/`` plus a commit
log ``<table>/_log/`` (JSON rows written by Spark, one per commit).

A version folder is written completely before its log row is appended, so
readers that resolve the contents from the log never see a partial write, and a
retried job simply rewrites the unlisted folder. One writer per table at a time
is assumed (as with the single-writer catalog it replaces). The same layout
works on any Hadoop file system URI.

A *full* version (build, replace, merge, compact) holds the whole table. An
*append* holds only its own rows, so loading a small delta writes a small
folder; the contents are the newest full version and the appends after it, a
change log that ``latest`` ranks by key and ``compact`` folds into a full version
now and then. Older version folders stay readable (time travel) until someone deletes
them.

The log is metadata, one small row per commit; what reaches the driver is the
newest row, or the rows since the newest full version, a number that
compaction keeps small.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType
from pyspark.sql.utils import AnalysisException

from auric.session import remove_path, replace_path, scratch_path

LOG_SCHEMA = StructType([
    StructField("version", LongType(), False),
    StructField("committed_at", TimestampType(), False),
    StructField("operation", StringType(), False),
    StructField("rows", LongType(), True),
    StructField("note", StringType(), True),
    StructField("max_cursor", TimestampType(), True),
])
LOAD_COLUMN = "_load"


class ShrinkRefused(RuntimeError):
    """A replace would drop more rows than the configured threshold."""


def path_missing(e: AnalysisException) -> bool:
    """Whether a read failed because nothing is there, and for no other reason."""
    return e.getCondition() == "PATH_NOT_FOUND"


@dataclass
class Written:
    """What a write saw: number of rows, greatest cursor, rows that may be loaded already."""

    rows: int
    top: _dt.datetime | None
    doubtful: int = 0


@dataclass
class LakeTable:
    spark: SparkSession
    path: str

    @classmethod
    def at(cls, spark: SparkSession, root: str, layer: str, table: str) -> LakeTable:
        return cls(spark, f"{root.rstrip('/')}/{layer}/{table}")

    @property
    def log_path(self) -> str:
        return f"{self.path}/_log"

    def version_path(self, version: int) -> str:
        return f"{self.path}/v={version}"

    # -- metadata ---------------------------------------------------------

    def log(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LOG_SCHEMA).json(self.log_path)
        except AnalysisException as e:
            if path_missing(e):
                return None
            raise

    def last(self) -> Row | None:
        """The newest commit."""
        log = self.log()
        if log is None:
            return None
        return next(iter(log.orderBy(F.col("version").desc()).limit(1).collect()), None)

    def current_version(self) -> int | None:
        last = self.last()
        return last["version"] if last else None

    def exists(self) -> bool:
        return self.last() is not None

    def is_dated(self) -> bool:
        """True for append-by-date tables (``partitionBy("snapshot_date")``)."""
        last = self.last()
        return last is not None and last["operation"] == "snapshot"

    def snapshot_dates(self) -> set[_dt.date]:
        """Dates recorded in the log of a dated table (including empty ones)."""
        log = self.log()
        if log is None:
            return set()
        return {_dt.date.fromisoformat(r["note"])
                for r in log.where("operation = 'snapshot'").select("note").distinct().collect()}

    def last_cursor(self):
        """Watermark stored with the newest commit (None if there is none)."""
        last = self.last()
        return last["max_cursor"] if last else None

    def history(self, limit: int = 10) -> DataFrame:
        """Newest commits first: snapshot_id, snapshot_time, operation, rows, note."""
        log = self.log()
        if log is None:
            log = self.spark.createDataFrame([], LOG_SCHEMA)
        return (log.select(F.col("version").alias("snapshot_id"),
                           F.col("committed_at").alias("snapshot_time"),
                           "operation", "rows", "note")
                .orderBy(F.col("snapshot_id").desc()).limit(limit))

    def append_log(self, version: int, operation: str, rows: int | None,
                   note: str | None = None, max_cursor=None) -> None:
        entry = [(version, _dt.datetime.now(_dt.timezone.utc), operation, rows, note, max_cursor)]
        (self.spark.createDataFrame(entry, LOG_SCHEMA).coalesce(1)
         .write.mode("append").json(self.log_path))

    def parts(self, version: int | None = None) -> list[int]:
        """Versions the contents (as of ``version``) consist of: the newest full one
        and the appends after it."""
        log = self.log()
        if log is None:
            return []
        if version is not None:
            log = log.where(F.col("version") <= version)
        full = log.where("operation <> 'append'").agg(F.max("version")).first()[0] or 0
        return sorted(r["version"] for r in
                      log.where(F.col("version") >= full).select("version").collect())

    # -- reads ------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame:
        """Current contents, or the contents at ``version`` (time travel).

        A dated table is read whole, less partitions its log does not list (what a
        failed append left); its history is its dates. A table with appends is a
        change log: see ``latest``."""
        if version is None and self.is_dated():
            dates = sorted(self.snapshot_dates())
            return (self.spark.read.parquet(self.path)
                    .where(F.col("snapshot_date").isin(*dates)))
        parts = self.parts(version)
        if not parts or (version is not None and parts[-1] != version):
            raise FileNotFoundError(f"no committed version {version or ''} at {self.path}")
        return (self.spark.read.option("mergeSchema", len(parts) > 1)
                .parquet(*[self.version_path(v) for v in parts]))

    def latest(self, pk, cursor: str, tie_breakers: Sequence[str] = ()) -> DataFrame:
        """The newest row of each key; of equal cursors the row loaded last."""
        from auric.operators.dedupe import latest_by_key
        rows = self.read()
        load = [LOAD_COLUMN] if LOAD_COLUMN in rows.columns else []
        return latest_by_key(rows, pk, cursor, [*tie_breakers, *load]).drop(LOAD_COLUMN)

    # -- writes -----------------------------------------------------------

    def _next(self) -> int:
        return (self.current_version() or 0) + 1

    def _write(self, df: DataFrame, version: int, cursor: str | None = None,
               doubtful: Column | None = None, path: str | None = None,
               mode: str = "overwrite") -> Written:
        """Write the folder of a version (or ``path``); rows, greatest cursor and rows that
        are ``doubtful`` are observed by the write itself, so nothing is read back."""
        # a folder for a version the log does not list is left over from a
        # failed attempt and is invisible to readers: overwrite it
        seen = Observation()
        stats = [F.count(F.lit(1)).alias("rows")]
        if cursor is not None:
            stats.append(F.max(F.col(f"`{cursor}`").cast("timestamp")).alias("top"))
        if doubtful is not None:
            stats.append(F.count_if(doubtful).alias("doubtful"))
        (df.observe(seen, *stats).write.mode(mode).option("compression", "zstd")
         .parquet(path or self.version_path(version)))
        got = seen.get
        return Written(got["rows"], got.get("top"), got.get("doubtful", 0))

    def commit(self, df: DataFrame, operation: str, note: str | None = None,
               max_cursor=None) -> int:
        """Write ``df`` as the next full version and record it in the log."""
        return self.commit_parts([df], operation, note, max_cursor)

    def commit_parts(self, parts: Sequence[DataFrame], operation: str, note: str | None = None,
                     max_cursor=None) -> int:
        """Write the rows of ``parts``, one after another, as the next full version and
        record it in the log."""
        v, rows = self._next(), 0
        for k, df in enumerate(parts):
            rows += self._write(df, v, mode="append" if k else "overwrite").rows
        self.append_log(v, operation, rows, note, max_cursor)
        return v

    def stored_rows(self) -> int:
        """Rows of the current contents by the log: those of a change log, not of its keys."""
        parts = self.parts()
        return self.log().where(F.col("version").isin(parts)).agg(F.sum("rows")).first()[0] or 0

    def append(self, batch: DataFrame, cursor: str | None = None,
               loaded: Callable[[], DataFrame] | None = None) -> int:
        """Write only ``batch``, marked with its load number. The stored watermark
        becomes max(previous watermark, greatest cursor of the written rows).

        ``loaded`` gives the digests of stored rows that may be in the batch once more;
        those are left out. It is asked only if the batch has rows that are not above the
        watermark: then the written folder is read back, and these rows alone compared."""
        from auric.operators.incremental import may_be_loaded, not_loaded
        last, v = self.last(), self._next()
        mark = F.lit(v).cast("bigint")
        doubt = None if loaded is None or last is None else \
            may_be_loaded(cursor, last["max_cursor"])
        written = self._write(batch.withColumn(LOAD_COLUMN, mark), v, cursor, doubt)
        if written.doubtful:
            rows = self.spark.read.parquet(self.version_path(v)).drop(LOAD_COLUMN)
            new = rows.where(~doubt).unionByName(not_loaded(rows.where(doubt), loaded()))
            staged = f"{self.path}/_staged-{uuid.uuid4().hex[:12]}"
            try:
                written = self._write(new.withColumn(LOAD_COLUMN, mark), v, cursor, path=staged)
                replace_path(self.spark, staged, self.version_path(v))
            finally:
                remove_path(self.spark, staged)
        top = max((t for t in (last["max_cursor"] if last else None, written.top)
                   if t is not None), default=None)
        self.append_log(v, "append", written.rows, None, top)
        return v

    def appended(self) -> list[DataFrame]:
        """The rows of each append since the newest full version, one frame for each."""
        parts = self.parts()
        if parts and not self.log().where((F.col("version") == parts[0])
                                          & (F.col("operation") == "append")).count():
            parts = parts[1:]
        return [self.spark.read.parquet(self.version_path(v)).drop(LOAD_COLUMN)
                for v in parts]

    def compact(self, pk, cursor: str, tie_breakers: Sequence[str] = ()) -> int:
        """Fold the change log into a full version with one row per key."""
        return self.commit(self.latest(pk, cursor, tie_breakers), "compact",
                           max_cursor=self.last_cursor())

    def replace(self, df: DataFrame, expected_rows: int | None = None,
                max_shrink: float | None = None) -> int:
        """Replace the whole table (e.g. a live-key snapshot).

        ``expected_rows`` is the completeness marker from the extract manifest:
        a replace whose row count differs is refused. ``max_shrink``, where given,
        refuses a replace that loses more than that share of the previous rows.

        The new version is written first and counted as it is written;
        only when the checks pass is its log row appended. A refused version
        stays unlisted (invisible) and is overwritten by the next commit, so
        the input is computed once.
        """
        last, v = self.last(), self._next()
        written = self._write(df, v)
        n = written.rows
        if expected_rows is not None and n != expected_rows:
            raise ShrinkRefused(f"{n} rows, manifest says {expected_rows}")
        before = last["rows"] if last else None
        if max_shrink is not None and before and n < before * (1 - max_shrink):
            raise ShrinkRefused(f"{n} rows would replace {before}")
        self.append_log(v, "replace", n)
        return v

    def merge(self, batch: DataFrame, pk, cursor: str | None = None,
              tie_breakers: Sequence[str] = (), keep_newer: bool = False) -> int:
        """Upsert ``batch`` by key into a new full version; the stored watermark
        becomes max(previous watermark, greatest batch cursor).

        The batch is reduced to its latest row per key and written once; the join,
        the union and the watermark all read that."""
        from auric.operators.dedupe import latest_by_key
        from auric.operators.merge import merge_upsert
        last, v = self.last(), self._next()
        ranked = scratch_path(self.spark, "merge-batch")
        if cursor is not None:
            batch = latest_by_key(batch, pk, cursor, tie_breakers)
        batch.write.parquet(ranked)
        batch = self.spark.read.schema(batch.schema).parquet(ranked)
        target = self.read() if last else None
        if target is not None and LOAD_COLUMN in target.columns:
            target = self.latest(pk, cursor, tie_breakers)
        written = self._write(merge_upsert(target, batch, pk, cursor, keep_newer=keep_newer,
                                           ranked=True), v)
        top = last["max_cursor"] if last else None
        if cursor is not None:
            got = batch.agg(F.max(F.col(f"`{cursor}`").cast("timestamp"))).first()[0]
            top = max((t for t in (top, got) if t is not None), default=None)
        self.append_log(v, "merge", written.rows, None, top)
        remove_path(self.spark, ranked)
        return v


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in ``path`` (a listing, no read)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def list_tables(spark: SparkSession, root: str, layer: str) -> DataFrame:
    """Tables of a layer (folders with a commit log), ordered by name."""
    base = f"{root.rstrip('/')}/{layer}"
    names = [t for t in _folders(spark, base) if "staging" not in t
             and "_log" in _folders(spark, f"{base}/{t}")]
    return spark.createDataFrame([(t,) for t in names], "table_name string")
