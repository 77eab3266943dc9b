"""Facts of one batch merged into the stored ones, day by day.

Only the days that a batch touches are read whole and written again; of all others no more than keys are read. The result is that of
cleaning all batches at once, as long as a repeated batch holds the keys that it held before.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom.operators import quality
from tradeloom.session import written
from tradeloom.sources import paths

DAY, BATCH, SIDE = "_day", "_batch", "_side"


def in_days(days: Sequence[date | None]) -> Column:
    """Rows of these days; as a condition on the folder it is a partition filter."""
    listed = F.col(DAY).isin([d for d in days if d is not None])
    return listed | F.col(DAY).isNull() if None in days else listed


def touched_days(stored: DataFrame, arrived: DataFrame, keys: Sequence[str], batch_id: str,
                 recheck: Callable[[DataFrame], DataFrame]) -> list[date | None]:
    """Days with a row that the batch brings, replaces, brought before, or makes acceptable; the list is as long as that."""
    incoming = arrived.select(*keys).dropna().distinct()
    # columns of keys only
    replaced = stored.select(*keys, DAY).join(incoming, [*keys], "left_semi").select(DAY)
    before = stored.where(F.col(BATCH) == batch_id).select(DAY)
    waiting = stored.where((F.col(SIDE) == "rejected") & F.exists(quality.REASONS, lambda r: r.startswith("unknown_")))
    now_known = recheck(waiting).where(F.size(quality.REASONS) == 0).select(DAY)
    days = arrived.select(DAY).unionByName(replaced).unionByName(before).unionByName(now_known).distinct()
    return [r[0] for r in days.collect()]


def merged(stored: DataFrame, arrived: DataFrame, keys: Sequence[str], batch_id: str, days: Sequence[date | None],
           recheck: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The rows of ``days`` after the batch: its rows replace those with their keys, the others are checked again."""
    incoming = arrived.select(*keys).dropna().distinct()
    # rows without a key match nothing and stay
    kept = stored.where(in_days(days)).where(F.col(BATCH) != batch_id).join(incoming, [*keys], "left_anti").drop(SIDE)
    return recheck(kept).select(*arrived.columns).unionByName(arrived)


def apply_batch(spark: SparkSession, path: str, tagged: DataFrame, keys: Sequence[str], day: Column, batch_id: str,
                recheck: Callable[[DataFrame], DataFrame]) -> list[date | None]:
    """Merge a batch of checked rows into the table at ``path``, stored by side and day; returns the days that were written.

    ``day`` may also be the first day of a longer period, for tables of which a day is few rows.
    ``recheck`` renews the reasons of stored rows that depend on other tables. The new days are complete in the shared folder
    before any folder of the table is replaced, so a repeated call after a failure gives the same table.
    """
    arrived = written(tagged.withColumns({DAY: day.cast("date"), BATCH: F.lit(batch_id)}), "arrived")
    if paths.exists(spark, path):
        stored = spark.read.parquet(path)
        days = touched_days(stored, arrived, keys, batch_id, recheck)
        rows = written(merged(stored, arrived, keys, batch_id, days, recheck), "merged-days")
    else:
        rows, days = arrived, [r[0] for r in arrived.select(DAY).distinct().collect()]
    sides = rows.withColumn(SIDE, F.when(F.size(quality.REASONS) == 0, F.lit("accepted")).otherwise(F.lit("rejected")))
    # rows of a day meet, days with many rows are split and small ones written by one task
    (sides.hint("rebalance", SIDE, DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(SIDE, DAY).parquet(path))
    # a day that has no row of one side any more was not replaced there
    filled = {(r[0], r[1]) for r in sides.select(SIDE, DAY).distinct().collect()}
    for side in ("accepted", "rejected"):
        for d in days:
            if (side, d) not in filled:
                paths.remove(spark, f"{path}/{SIDE}={side}/{DAY}={d.isoformat() if d else '__HIVE_DEFAULT_PARTITION__'}")
    return days


def read_sides(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected) rows without the columns of the layout."""
    good, bad = quality.read_split(spark, path)
    return good.drop(DAY, BATCH), bad.drop(DAY, BATCH)
