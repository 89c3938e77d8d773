"""Bucketed tables: rows kept by a hash of their key, sorted by it, as Spark's own tables.

A ranking by the key, and a join of two tables with the same buckets on it, read such
tables without a shuffle: each bucket is one task's, whatever the table's size. The shuffle
is paid once, when the table is written. Size ``buckets`` so that one is a few hundred MB.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from auric.operators.dedupe import q


def write_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """Write ``df`` as the table ``name`` with its files under ``path`` (one for each bucket)
    and return it."""
    (df.repartition(buckets, q(key)).write.bucketBy(buckets, key).sortBy(key)
     .mode("overwrite").option("path", path).format("parquet").saveAsTable(name))
    return df.sparkSession.table(name)
