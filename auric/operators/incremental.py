"""High-watermark incremental reads.

The cursor state of a table is the greatest cursor it holds. A run reads
source rows strictly newer than ``last - lag``: the lag re-reads a small
overlap so rows committed late at the source boundary are not missed, and
the merge by key makes the re-read harmless.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.operators.dedupe import q

EPOCH = _dt.datetime(1970, 1, 1, tzinfo=_dt.timezone.utc)


def _ts_lit(v) -> Column:
    if isinstance(v, Column):
        return v
    if isinstance(v, str):
        v = _dt.datetime.fromisoformat(v.replace("Z", "+00:00"))
    if isinstance(v, _dt.datetime) and v.tzinfo is None:
        v = v.replace(tzinfo=_dt.timezone.utc)
    return F.lit(v)


def watermark(last_value=None, lag_seconds: int = 0, seed_since=None) -> Column:
    """``since = (last or seed or epoch) - lag`` as a timestamp literal.

    ``seed_since`` only bounds the first run (no stored state yet)."""
    start = last_value if last_value is not None else (seed_since or EPOCH)
    since = _ts_lit(start)
    if lag_seconds:
        since = since - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(lag_seconds))
    return since


def incremental_since(df: DataFrame, cursor: str, last_value=None,
                      lag_seconds: int = 0, seed_since=None,
                      keep_unreadable: bool = False) -> DataFrame:
    """Rows with ``cursor > since`` (strict). The comparison is on the raw
    cursor column, so it reaches the Parquet scan as a pushed filter.

    ``keep_unreadable`` also keeps rows whose cursor is NULL (missing or not a
    date): their age is unknown, so a load must not lose them."""
    since = watermark(last_value, lag_seconds, seed_since)
    c = q(cursor)
    dtype = df.schema[cursor].dataType.simpleString()
    if dtype == "timestamp_ntz":
        since = since.cast("timestamp_ntz")
    return df.where((c > since) | c.isNull() if keep_unreadable else c > since)


def may_be_loaded(cursor: str, last_value=None) -> Column:
    """Whether a row may be in a table whose greatest cursor is ``last_value``: its cursor
    cannot be read or is not above that. The stored value is cut to milliseconds."""
    c = q(cursor).cast("timestamp")
    if last_value is None:
        return c.isNull()
    return c.isNull() | (c < _ts_lit(last_value) + F.expr("INTERVAL '0.001' SECOND"))


def row_digest(df: DataFrame) -> Column:
    """SHA-256 of a row's contents by column name: the order of the columns and columns
    that are NULL or missing do not matter."""
    names = sorted(df.columns, key=lambda c: (c.lower(), c))
    return F.sha2(F.to_json(F.struct(*[q(c) for c in names])), 256)


def not_loaded(batch: DataFrame, loaded: DataFrame | None) -> DataFrame:
    """Rows of ``batch`` whose contents are not among the digests (column ``digest``) of
    ``loaded``. A source that sends a row again unchanged, because its age is unknown or it
    lies in the overlap, adds nothing."""
    if loaded is None:
        return batch
    marked = batch.withColumn("_digest", F.unhex(row_digest(batch)))
    return marked.join(loaded.select(F.unhex("digest").alias("_digest")), "_digest",
                       "left_anti").drop("_digest")


def may_come_again(rows: DataFrame, cursor: str, last_value, lag_seconds: int = 0) -> DataFrame:
    """(digest, cursor) of the rows a later load may bring once more: those without a
    readable cursor and those in the overlap below ``last_value``."""
    again = rows if last_value is None else incremental_since(
        rows, cursor, last_value, lag_seconds, keep_unreadable=True)
    return again.select(row_digest(rows).alias("digest"),
                        q(cursor).cast("timestamp").alias("cursor"))


def max_cursor(df: DataFrame, cursor: str) -> DataFrame:
    """One-row frame with the greatest cursor (the state a run stores)."""
    return df.agg(F.max(q(cursor)).alias("max_cursor"))
