"""Silver operators: soft-delete filter, latest row per key, hard-delete
reconciliation against a live-key snapshot, column projection.

Plan shape at scale (checked in tests/test_plans.py):

* ``latest_by_key`` is ``row_number() over (partition by pk order by cursor
  desc, tie...) = 1``. Catalyst turns it into a partial ``WindowGroupLimit``
  before the shuffle, so every map task forwards at most one row per key: a key
  that owns a third of the rows costs one row per map task in the exchange, not
  a third of the table in one reducer.
* ``hard_delete_semi_join`` is a left-semi join on the pk. The window output is
  already hash-partitioned on the pk, so only the live-key side is shuffled
  (or broadcast by AQE when its runtime size is small). ``silver_dedupe`` puts it above
  the ranking: below it, a join that is not broadcast would shuffle the whole log with
  all its columns and leave a hot key unsplit. Spark then adds a Bloom filter of the live
  keys to the scan (``spark.sql.optimizer.runtime.bloomFilter.*``, see ``CLUSTER_CONF``),
  so most rows of dead keys are gone before they are ranked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.functions.casts import safe_bool

TECHNICAL_COLUMNS = ("_rn", "_load", "_dlt_load_id", "_dlt_id")
SOFT_DELETE_FLAG = "IsDeleted"


def q(name: str) -> Column:
    """Column by its exact (possibly unusual) name."""
    return F.col(f"`{name}`")


def find_column(df: DataFrame, name: str) -> str | None:
    """Case-insensitive column lookup; returns the stored spelling."""
    low = name.lower()
    for c in df.columns:
        if c.lower() == low:
            return c
    return None


def _order(cursor: str | Column, tie_breakers: Sequence[str | Column]) -> list[Column]:
    cols = [cursor] + list(tie_breakers)
    out = []
    for c in cols:
        c = q(c) if isinstance(c, str) else c
        out.append(c.desc_nulls_last())
    return out


def soft_delete_filter(df: DataFrame, flag: str = SOFT_DELETE_FLAG) -> DataFrame:
    """Drop rows whose flag reads as true (boolean, or text such as 'true',
    'True', '1'); NULL or unreadable flags count as live. No-op when the column
    is absent (some entities have no flag)."""
    name = find_column(df, flag)
    if name is None:
        return df
    dtype = df.schema[name].dataType
    return df.where(~F.coalesce(safe_bool(q(name), dtype), F.lit(False)))


def key_slice(df: DataFrame, pk: str, k: int, slices: int) -> DataFrame:
    """The rows whose key falls in slice ``k`` of ``slices`` by its hash; the rows of a key,
    NULL as well, are all in one slice."""
    return df.where(F.pmod(F.xxhash64(q(find_column(df, pk) or pk)), F.lit(slices)) == k)


def latest_by_key(df: DataFrame, pk: str | Sequence[str], cursor: str | Column,
                  tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the row with the greatest cursor per key (NULL cursors rank last).

    ``tie_breakers`` (descending) make the winner deterministic when cursors tie.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    w = Window.partitionBy(*[q(k) for k in keys]).orderBy(*_order(cursor, tie_breakers))
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1)
              .drop("_rn"))


def hard_delete_semi_join(df: DataFrame, live_ids: DataFrame, pk: str,
                          cursor: str | None = None, grace_after=None) -> DataFrame:
    """Keep rows whose key is still in the live-key snapshot (``pk IN (...)``).

    A left-semi join: duplicate or NULL live ids change nothing.

    ``grace_after`` (with ``cursor``): also keep rows changed after that time,
    i.e. after the live-key snapshot was taken, so rows created since the last
    reconcile are not dropped until the next one. The two parts (semi join,
    anti join filtered by time) are disjoint, so no row is duplicated.
    """
    live_pk = find_column(live_ids, pk) or pk
    ids = live_ids.select(q(live_pk).alias(pk))
    kept = df.join(ids, on=pk, how="left_semi")
    if grace_after is None:
        return kept
    if cursor is None:
        raise ValueError("grace_after needs the cursor column")
    from auric.operators.incremental import incremental_since
    recent = incremental_since(df.join(ids, on=pk, how="left_anti"), cursor, grace_after)
    return kept.unionByName(recent)


def project_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Ordered projection to configured columns, resolved case-insensitively and
    returned with the configured spelling."""
    out = []
    for c in columns:
        stored = find_column(df, c)
        if stored is None:
            raise ValueError(f"column {c!r} not in {df.columns}")
        out.append(q(stored).alias(c))
    return df.select(*out)


def drop_technical(df: DataFrame, extra: Sequence[str] = (),
                   drop_matching: str | None = None) -> DataFrame:
    """Keep everything except load metadata / ranking columns, and columns
    whose name contains ``drop_matching`` (e.g. '@' for OData annotations)."""
    drop = {c.lower() for c in (*TECHNICAL_COLUMNS, *extra)}
    return df.select(*[q(c) for c in df.columns if c.lower() not in drop
                       and not (drop_matching and drop_matching in c)])


def silver_dedupe(df: DataFrame, pk: str, cursor: str,
                  has_soft_delete: bool = True,
                  columns: Sequence[str] | None = None,
                  live_ids: DataFrame | None = None,
                  tie_breakers: Sequence[str | Column] = (),
                  delete_filter: str = "before",
                  drop_matching: str | None = None,
                  grace_after=None) -> DataFrame:
    """The full silver transform of one entity.

    Order: soft-delete filter -> latest per key -> live-key semi join -> projection (or
    keep-all minus technical columns). The semi join keeps or drops whole keys, so it
    commutes with the ranking; it comes after, where a key has one row left and the
    ranking's partitioning serves the join as well.

    ``delete_filter="before"`` filters deleted rows before ranking (bronze is
    already merged to one row per key). ``"after"`` ranks first, so a newer
    deleted version hides older live ones; use it on append-only change logs.
    ``drop_matching`` and ``grace_after`` are passed to ``drop_technical`` and
    ``hard_delete_semi_join``.
    """
    if delete_filter not in ("before", "after"):
        raise ValueError("delete_filter must be 'before' or 'after'")
    out = df
    if has_soft_delete and delete_filter == "before":
        out = soft_delete_filter(out)
    out = latest_by_key(out, pk, cursor, tie_breakers)
    if has_soft_delete and delete_filter == "after":
        out = soft_delete_filter(out)
    if live_ids is not None:
        out = hard_delete_semi_join(out, live_ids, pk, cursor, grace_after)
    if columns is not None:
        return project_columns(out, columns)
    return drop_technical(out, drop_matching=drop_matching)
