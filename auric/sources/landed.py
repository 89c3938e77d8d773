"""Scans of landed source extracts.

The source systems deliver three shapes, each read by Spark file splits:

* CSV chunks (full backfill): header row, every value text, '' for NULL,
  ISO datetimes. Columns are bound by header name; no type inference.
* JSON batches (incremental): typed records with an ``attributes`` envelope
  and epoch-millisecond datetimes. Read with ``primitivesAsString`` so every
  scalar arrives as its text.
* Paged JSON documents: ``{"value": [...], "@odata.nextLink": ...}``; each
  page's ``value`` array is exploded into rows with ``inline``. Column names
  such as ``x@OData.Community.Display.V1.FormattedValue`` are kept.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BinaryType, DataType, MapType, StringType,
                               StructField, StructType)
from pyspark.sql.utils import AnalysisException

from auric.functions.normalize import normalize_record, parse_cursor
from auric.operators.dedupe import q
from auric.specs import EXCLUDED_FIELD_TYPES


LEDGER_SCHEMA = "kind string, path string, modified timestamp, length bigint, rows bigint"


class LandingLedger:
    """Which landed files a table has loaded: one row for each file, written after the load
    it was part of is committed. A file counts as new if its path, time and length are not
    listed, so one that was replaced is loaded again. A load that fails before its files are
    listed is repeated whole."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def loaded(self) -> DataFrame:
        try:
            return self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], LEDGER_SCHEMA)

    def has_rows(self, kind: str) -> bool:
        """Whether a load of this kind has brought rows."""
        return not self.loaded().where((F.col("kind") == kind) & (F.col("rows") > 0)).isEmpty()

    def new_files(self, folder: str) -> list[Row]:
        """(path, modified, length) of the files below ``folder`` not loaded yet; a folder
        that does not exist has none. Only the listing is read, and only names come to the
        driver, as for any read of them."""
        try:
            files = (self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
                     .load(folder))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        return (files.select("path", F.col("modificationTime").alias("modified"), "length")
                .join(self.loaded(), ["path", "modified", "length"], "left_anti")
                .orderBy("path").collect())

    def add(self, kind: str, files: Sequence[Row], rows: int) -> None:
        entries = [(kind, f["path"], f["modified"], f["length"], rows) for f in files]
        (self.spark.createDataFrame(entries, LEDGER_SCHEMA)
         .coalesce(1).write.mode("append").parquet(self.path))


def landed_variant_scan(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """JSON lines as one VARIANT column ``record``, types as delivered and no inference: a
    field may be a number in one batch, text in the next and missing in a third. A line that
    is not a JSON value fails the scan; empty lines are skipped."""
    return (spark.read.text(_paths(path)).where(F.trim("value") != "")
            .select(F.parse_json("value").alias("record")))


def variant_fields(records: DataFrame) -> dict[str, set[str]]:
    """Field names of a VARIANT column of objects with the types they occur in, of all
    rows. The driver gets a row for each (field, type)."""
    fields = records.sparkSession.tvf.variant_explode(F.col("record").outer())
    found = records.lateralJoin(fields).select(F.col("key").alias("name"),
                                               F.schema_of_variant("value").alias("type"))
    out: dict[str, set[str]] = {}
    for r in found.distinct().collect():
        out.setdefault(r["name"], set()).add(r["type"])
    return out


def variant_columns(records: DataFrame, names: Iterable[str]) -> DataFrame:
    """The named fields of a VARIANT column as text columns: scalars as their text, objects
    and lists as JSON, NULL where a record lacks the field."""
    def field(name: str):
        quote = "'" if '"' in name else '"'
        if quote in name:
            raise ValueError(f"field name with both kinds of quotes: {name}")
        return F.try_variant_get("record", f"$[{quote}{name}{quote}]", "string").alias(name)
    return records.select(*[field(n) for n in names])


def _paths(path: str | Sequence[str]) -> str | list[str]:
    return path if isinstance(path, str) else list(path)


def landed_csv_scan(spark: SparkSession, path: str | Sequence[str],
                    columns: Sequence[str] | None = None,
                    multi_line: bool = False) -> DataFrame:
    """Header CSV, every column text, columns bound by their header names.

    Without ``columns`` every column of the header is returned; with it those
    columns, in that order, wherever the files have them. All files of a folder
    must have the same header: one that differs in a name or the order fails the
    scan rather than shift values between columns.

    Files are split between tasks. ``multi_line=True`` is for exports whose quoted
    fields hold line breaks; such a file is read whole by one task, so land these
    as many bounded chunks. A line break inside quotes without it fails the scan.
    """
    raw = (spark.read.option("header", True).option("enforceSchema", False)
           .option("multiLine", multi_line).option("escape", '"')
           .option("mode", "FAILFAST").csv(_paths(path)))
    return raw if columns is None else raw.select(*[q(c) for c in columns])


def landed_json_scan(spark: SparkSession, path: str | Sequence[str],
                     schema: StructType | None = None) -> DataFrame:
    """JSON lines, scalars as text. Pass ``schema`` in production so no
    inference pass runs over the landing folder."""
    r = spark.read.option("primitivesAsString", True).option("mode", "FAILFAST")
    if schema is not None:
        r = r.schema(schema)
    return r.json(_paths(path))


def paged_json_explode(spark: SparkSession, path: str | Sequence[str],
                       record_schema: StructType | None = None,
                       multi_line: bool = False) -> DataFrame:
    """Rows of every page document under ``path``. Without ``record_schema`` one pass
    over the pages infers it.

    ``multi_line=True`` reads one pretty-printed document per file (as the
    API returns them); each file is bounded by the page size. A page that is cut
    short or holds a value of another type fails the scan.
    """
    pages = spark.read.option("multiLine", multi_line).option("mode", "FAILFAST")
    if record_schema is not None:
        pages = pages.schema(StructType([
            StructField("value", ArrayType(record_schema), True),
            StructField("@odata.nextLink", StringType(), True)]))
    docs = pages.json(_paths(path))
    return docs.select(F.inline(F.col("value")))


def select_queryable_columns(df: DataFrame,
                             excluded: Iterable[type[DataType]] = (ArrayType, MapType,
                                                                   StructType, BinaryType),
                             described: Mapping[str, str] | None = None) -> DataFrame:
    """Every column except compound and binary ones (the shapes a bulk
    extract cannot carry). ``described`` gives the source's own type names by
    column; those of the source's compound and binary types go too, whatever they
    were landed as."""
    excluded = tuple(excluded)
    types = {c.lower(): t.lower() for c, t in (described or {}).items()}
    keep = [f.name for f in df.schema.fields if not isinstance(f.dataType, excluded)
            and types.get(f.name.lower()) not in EXCLUDED_FIELD_TYPES]
    return df.select(*[q(c) for c in keep])


def live_ids_snapshot(df: DataFrame, pk: str) -> DataFrame:
    """The full set of live keys: a one-column projection of a full export."""
    return df.select(q(pk).cast(StringType()).alias(pk)).where(q(pk).isNotNull())


def backfill_from_csv(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None,
                      cursor: str, multi_line: bool = False) -> DataFrame:
    """First-run bronze batch: CSV text, cursor parsed as zoned ISO only."""
    return normalize_record(landed_csv_scan(spark, path, columns, multi_line), cursor,
                            allow_epoch_ms=False)


def delta_from_variant(spark: SparkSession, path: str | Sequence[str], cursor: str) -> DataFrame:
    """Incremental bronze batch of records whose fields come, go and change type between
    files: the columns are all fields that any record has, as text; a number's text is that
    of its value (``1.50`` is 1.5). No schema is inferred."""
    records = landed_variant_scan(spark, path)
    names = sorted({*variant_fields(records), cursor})
    return normalize_record(variant_columns(records, names), cursor, allow_epoch_ms=True)


LANDING_PARTITION = "ingest_date"


def delta_from_json(spark: SparkSession, path: str | Sequence[str], cursor: str,
                    schema: StructType | None = None, since=None,
                    lag_seconds: int = 0) -> DataFrame:
    """Incremental bronze batch: JSON text, cursor as epoch ms or ISO.

    When the landing folder is partitioned by ``ingest_date=YYYY-MM-DD`` and a
    watermark ``since`` is given, only partitions from the day before
    ``since - lag`` on are read (partition pruning; a record lands on the day of its
    change or later), so a run does not rescan every delta ever landed. The
    partition column is not part of the record.
    """
    raw = landed_json_scan(spark, path, schema)
    if LANDING_PARTITION in raw.columns:
        if since is not None:
            start = (since - _dt.timedelta(days=1, seconds=lag_seconds)).date().isoformat()
            raw = raw.where(F.col(LANDING_PARTITION) >= F.lit(start))
        raw = raw.drop(LANDING_PARTITION)
    return normalize_record(raw, cursor, allow_epoch_ms=True)


def delta_from_pages(spark: SparkSession, path: str | Sequence[str], cursor: str,
                     record_schema: StructType | None = None) -> DataFrame:
    """Bronze batch of a paged source: columns as delivered, annotations included;
    only the cursor is read as a UTC timestamp (NULL where it cannot be)."""
    rows = paged_json_explode(spark, path, record_schema)
    return rows.withColumn(cursor, parse_cursor(q(cursor), rows.schema[cursor].dataType))


def load_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV seed (e.g. the regions table): the declared columns by their header
    names, cast to the declared types."""
    want = StructType.fromDDL(schema)
    raw = landed_csv_scan(spark, path, want.fieldNames())
    return raw.select(*[q(f.name).cast(f.dataType).alias(f.name) for f in want.fields])
