"""Reading the given tables and cutting lineage through the shared folder."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from auric.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back: later
    stages start from files that outlive any executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def shuffled_join(left: DataFrame, right: DataFrame, on, how: str = "inner") -> DataFrame:
    """``left.join(right)`` with both sides shuffled and neither sent to the driver. For
    sides that grow with the input: Spark broadcasts what it takes for small, and it counts
    an array as one element, exploded or not, and stored rows by their compressed bytes."""
    return left.hint("merge").join(right.hint("merge"), on, how)


def plain_names(df: DataFrame) -> DataFrame:
    """The same columns named c0, c1, ... (names with dots or clashes do no harm then)."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])


def blocks(df: DataFrame, key: str, *limits: tuple[Column, int]) -> Iterator[list[Row]]:
    """The rows of ``df`` for the driver, block by block. A block is the rows of some values
    of ``key`` (a hash); each limit is a size of a row and the most a block may have of it.
    The blocks' sizes are counted before any is collected, and blocks made smaller until all
    keep to the limits or hold a single key."""
    sums = [F.sum(size).alias(f"s{k}") for k, (size, _) in enumerate(limits)]
    over = " OR ".join(f"s{k} > {most}" for k, (_, most) in enumerate(limits))
    whole = df.agg(*sums).first()
    n = max([1] + [math.ceil((x or 0) / most) for x, (_, most) in zip(whole, limits)])
    while True:
        part = F.pmod(F.col(key), F.lit(n))
        sizes = df.groupBy(part.alias("part")).agg(F.countDistinct(key).alias("keys"), *sums)
        if sizes.where(f"keys > 1 AND ({over})").isEmpty():
            break
        n *= 2
    for k in range(n):
        rows = df.where(part == k).collect()
        if rows:
            yield rows
