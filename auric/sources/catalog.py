"""Catalog-style views of frames and tables: row counts, column listings."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.sources.lake import LOAD_COLUMN, LakeTable, list_tables
from auric.specs import EntitySpec

LAYERS = ("bronze", "silver", "gold")


def footer_session(spark: SparkSession) -> SparkSession:
    """A session beside ``spark`` (same context) that reads Parquet through the source that
    answers count, min and max of whole files from their footers."""
    beside = spark.newSession()
    beside.conf.set("spark.sql.sources.useV1SourceList", "avro,csv,json,kafka,orc,text")
    beside.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return beside


def table_row_counts(tables: Mapping[str, DataFrame],
                     exclude_like: str | None = r"\_dlt%",
                     escape: str = "\\") -> DataFrame:
    """``(table, rows)`` for every table, as one union of global counts.

    Names matching ``exclude_like`` (SQL LIKE with ``escape``) are skipped;
    the default skips load-metadata tables named ``_dlt...``. ``footer_row_counts`` does
    the same for Parquet folders without scanning rows.
    """
    names = list(tables)
    if exclude_like and names:
        spark = next(iter(tables.values())).sparkSession
        kept = spark.createDataFrame([(n,) for n in names], "t string").where(
            ~F.like("t", F.lit(exclude_like), F.lit(escape)))
        names = [r["t"] for r in kept.collect()]     # table names only
    if not names:
        raise ValueError("no tables to count")
    return reduce(lambda a, b: a.unionByName(b), [
        tables[n].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "rows")
        for n in names])


def footer_row_counts(spark: SparkSession, paths: Mapping[str, str],
                      exclude_like: str | None = r"\_dlt%", escape: str = "\\") -> DataFrame:
    """``table_row_counts`` of Parquet files or folders, by their footers alone."""
    beside = footer_session(spark)
    return table_row_counts({n: beside.read.parquet(p) for n, p in paths.items()},
                            exclude_like, escape)


def describe_columns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """``(column_name, data_type, ordinal_position)`` of a frame's schema."""
    rows = [(f.name, f.dataType.simpleString(), i + 1) for i, f in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "column_name string, data_type string, "
                                       "ordinal_position int")


def has_column(df: DataFrame, name: str) -> bool:
    """Case-insensitive column existence probe."""
    return name.lower() in {c.lower() for c in df.columns}


def adhoc_sql(spark: SparkSession, text: str, args: Mapping | None = None,
              **tables: DataFrame) -> DataFrame:
    """Run SQL text over the given frames, referenced as ``{name}``, with
    optional named parameters (``:param``)."""
    return spark.sql(text, args=dict(args) if args else None, **tables)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def view_text(table: LakeTable, spec: EntitySpec | None = None) -> str:
    """SQL text that reads the current contents of a table from its files: a change log
    with its newest row of each key (``spec``), a dated table with the dates of its log."""
    rows = table.read()
    names = [c for c in rows.columns if c != LOAD_COLUMN]
    columns = ", ".join(map(_quoted, names))
    if table.is_dated():
        dates = ", ".join(f"DATE '{d}'" for d in sorted(table.snapshot_dates()))
        return f"SELECT {columns} FROM parquet.{_quoted(table.path)} WHERE snapshot_date IN ({dates})"
    parts = []
    for v in table.parts():
        path = table.version_path(v)
        has = {c.lower(): c for c in table.spark.read.parquet(path).columns}
        parts.append("SELECT " + ", ".join(
            _quoted(has[f.name.lower()]) if f.name.lower() in has
            else f"CAST(NULL AS {f.dataType.simpleString()}) AS {_quoted(f.name)}"
            for f in rows.schema.fields) + f" FROM parquet.{_quoted(path)}")
    text = " UNION ALL ".join(parts)
    if spec is None or LOAD_COLUMN not in rows.columns:
        return f"SELECT {columns} FROM ({text})"
    order = ", ".join(f"{_quoted(c)} DESC NULLS LAST"
                      for c in (spec.cursor, *spec.tie_breakers, LOAD_COLUMN))
    return (f"SELECT {columns} FROM (SELECT *, row_number() OVER "
            f"(PARTITION BY {_quoted(spec.pk)} ORDER BY {order}) AS _rn FROM ({text})) WHERE _rn = 1")


def register_layers(spark: SparkSession, lake_root: str, specs: Sequence[EntitySpec] = (),
                    layers: Iterable[str] = LAYERS) -> list[str]:
    """A catalog database for each layer of the lake with a view for each of its tables, so
    that SQL text can name them (``gold.members``). Returns the names. Views read the
    versions current now; register again after a build. A view of a bronze change log whose
    entity is in ``specs`` shows the newest row of each key; a database is made where there
    is none, and views of tables that are gone are dropped."""
    by_table = {s.table: s for s in specs}
    done = []
    for layer in layers:
        names = [r["table_name"] for r in list_tables(spark, lake_root, layer).collect()]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quoted(layer)} "
                  f"LOCATION '{lake_root.rstrip('/')}/_catalog/{layer}'")
        for old in spark.catalog.listTables(layer):
            if not old.isTemporary and old.tableType == "VIEW" and old.name not in names:
                spark.sql(f"DROP VIEW {_quoted(layer)}.{_quoted(old.name)}")
        for t in names:
            table = LakeTable.at(spark, lake_root, layer, t)
            if table.is_dated() and not table.log().agg(F.sum("rows")).first()[0]:
                continue                          # no files to read yet
            spark.sql(f"CREATE OR REPLACE VIEW {_quoted(layer)}.{_quoted(t)} AS "
                      + view_text(table, by_table.get(t) if layer == "bronze" else None))
            done.append(f"{layer}.{t}")
    return done
