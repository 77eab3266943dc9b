"""Looking at partitions and plans, and holding on to a reused table."""

from __future__ import annotations

import io
from collections.abc import Iterator, Sequence
from contextlib import contextmanager, redirect_stdout

from pyspark.sql import DataFrame, Window, functions as F
from pyspark.storagelevel import StorageLevel


def rows_per_partition(df: DataFrame) -> DataFrame:
    """Rows in each partition; empty partitions have no row."""
    return (df.groupBy(F.spark_partition_id().alias("partition_id"))
            .agg(F.count(F.lit(1)).alias("rows")).orderBy("partition_id"))


def keys_whole(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One value: whether all rows of each key lie in one partition."""
    placed = df.select(*keys, F.spark_partition_id().alias("_part"))
    parts = placed.groupBy(*keys).agg(F.min("_part").alias("_first"), F.max("_part").alias("_last"))
    return parts.agg(F.coalesce(F.bool_and(F.col("_first") == F.col("_last")), F.lit(True)).alias("keys_whole"))


def ranges_apart(df: DataFrame, column: str) -> DataFrame:
    """One value: whether every partition's values lie beyond those of the partitions before it."""
    bounds = df.groupBy(F.spark_partition_id().alias("_part")).agg(F.min(column).alias("_low"), F.max(column).alias("_high"))
    # a row per partition
    before = F.max("_high").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    return bounds.select((F.col("_low") > before).alias("_apart")).agg(F.coalesce(F.bool_and("_apart"), F.lit(True)).alias("ranges_apart"))


@contextmanager
def reused(df: DataFrame) -> Iterator[DataFrame]:
    """The table kept in memory (spilling to disk) inside the block and released after it.

    A lost executor only costs recomputing its blocks.
    """
    kept = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield kept
    finally:
        kept.unpersist()


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """What ``explain`` prints, for tests and logs."""
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain(mode=mode)
    return out.getvalue()
