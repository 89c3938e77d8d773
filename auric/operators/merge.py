"""Merge by primary key (upsert) without a row-level table format.

``merge_upsert`` returns the new table contents: stored rows whose key is not
in the batch, plus the latest batch row per key. The caller writes the result
as a new version (``auric.sources.lake.LakeTable``), never over its own input.

At scale the batch (one incremental pull) is small next to the stored table.
The anti join is planned as a shuffled join unless the batch-key side is
under the broadcast threshold, which AQE checks at run time from the actual
shuffle size. Loads append their batch instead (``LakeTable.append``) and leave
the rewrite of the table to an occasional ``compact``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from auric.operators.dedupe import latest_by_key, q


def _keys(pk: str | Sequence[str]) -> list[str]:
    return [pk] if isinstance(pk, str) else list(pk)


def merge_upsert(target: DataFrame | None, batch: DataFrame, pk: str | Sequence[str],
                 cursor: str | None = None,
                 tie_breakers: Sequence[str | Column] = (),
                 keep_newer: bool = False, ranked: bool = False) -> DataFrame:
    """Incoming rows replace stored rows with an equal key; other stored rows
    are kept. The batch is first reduced to its latest row per key, unless it is
    ``ranked`` already. It is read twice (join and union): pass one that is stored.

    ``keep_newer=True`` keeps a stored row whose cursor is greater than the
    incoming one (an out-of-order re-delivery does not roll a row back).
    Columns present on one side only are filled with NULL on the other.
    """
    keys = _keys(pk)
    if cursor is not None and not ranked:
        batch = latest_by_key(batch, keys, cursor, tie_breakers)
    if target is None:
        return batch
    if keep_newer:
        if cursor is None:
            raise ValueError("keep_newer needs a cursor")
        b = batch.select(*[q(k) for k in keys], q(cursor).alias("_b_cursor"))
        t = target.join(b, keys, "left")
        newer = (t.where(F.col("_b_cursor").isNotNull() & (q(cursor) > F.col("_b_cursor")))
                  .drop("_b_cursor"))           # stored row is newer than the incoming one
        kept = t.where(F.col("_b_cursor").isNull()).drop("_b_cursor")
        batch = batch.join(newer.select(*keys), keys, "left_anti")
        return kept.unionByName(newer, allowMissingColumns=True).unionByName(
            batch, allowMissingColumns=True)
    kept = target.join(batch.select(*[q(k) for k in keys]), keys, "left_anti")
    return kept.unionByName(batch, allowMissingColumns=True)

