"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from tradeloom.operators.ordering import sort_columns


def dedup_latest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                 tiebreak: Sequence[str]) -> DataFrame:
    """Keep the first row of each key in ``order``, ties settled by ``tiebreak``.

    Both lists are required: without a total order the survivor would change from run to
    run. The planner keeps one row per key and map task before the shuffle
    (``WindowGroupLimit``), so a key with a third of all rows sends one row per task.
    """
    if not order or not tiebreak:
        raise ValueError("dedup_latest needs order and tiebreak columns that make a total order")
    newest_first = Window.partitionBy(*keys).orderBy(*sort_columns([*order, *tiebreak]))
    return df.withColumn("_rn", F.row_number().over(newest_first)).filter("_rn = 1").drop("_rn")
