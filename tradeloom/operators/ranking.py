"""Positions, ranks and tiles that no single task has to compute.

A window runs each of its partitions in one task. That is right while the largest group is
small, and the functions here measure it first. Beyond ``max_task_rows`` the rows are sorted
across the cluster into ordered buckets, written once with their place inside the bucket,
and numbered by adding the sizes of the buckets before.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tradeloom.operators.joins import lookup_join
from tradeloom.operators.ordering import sort_columns, sort_names
from tradeloom.operators.skew import shuffle_partitions
from tradeloom.session import written

MAX_TASK_ROWS = 1_000_000
BUCKET_ROWS = 100_000
_BUCKET, _INDEX, _POSITION = "_bucket", "_index", "_position"


def largest_group(df: DataFrame, group: Sequence[str]) -> int:
    """Rows of the largest group; counts are combined before the shuffle."""
    counts = df.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.max("n")).first()[0] or 0


def buckets_for(df: DataFrame, rows: int) -> int:
    """Buckets for a known number of rows: each holds about ``BUCKET_ROWS``."""
    return max(8, rows // BUCKET_ROWS)


def _numbered(df: DataFrame, order: Sequence[str], buckets: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows with bucket and position counted from 1, one size row per bucket).

    The range partitioning puts rows in order over the buckets, splitting ties where the last
    sort keys differ. The written table fixes each row's place, so that counting and numbering
    agree even if a task is run again.
    """
    keys = sort_columns(order)
    placed = (df.repartitionByRange(buckets or shuffle_partitions(df), *keys)
              .sortWithinPartitions(*keys)
              .withColumn("_at", F.monotonically_increasing_id()))
    # the id is the partition number in the upper bits and the row's place in the lower 33
    rows = written(placed.withColumn(_BUCKET, F.shiftright("_at", 33))
                   .withColumn(_INDEX, F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
                   .drop("_at"), "ordered")
    sizes = rows.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_size"))
    # one row per bucket: the only thing that is added up in a single task and broadcast
    before = F.sum("_size").over(Window.orderBy(_BUCKET)) - F.col("_size")
    offsets = sizes.select(_BUCKET, before.alias("_before"))
    numbered = (rows.join(F.broadcast(offsets), _BUCKET)
                .withColumn(_POSITION, F.col("_before") + F.col(_INDEX) + 1)
                .drop("_before", _INDEX))
    return numbered, sizes


def spread_row_number(df: DataFrame, order: Sequence[str], out: str,
                      buckets: int | None = None) -> DataFrame:
    """Number all rows 1..N in a total order."""
    numbered, _ = _numbered(df, order, buckets)
    return numbered.withColumn(out, F.col(_POSITION)).drop(_BUCKET, _POSITION)


def tile_of(position: Column, total: Column, k: int) -> Column:
    """Tile 1..k of a position 1..total; the first tiles take the rows left over."""
    size, extra = F.floor(total / k), total % k
    in_larger = extra * (size + 1)
    return F.when(position <= in_larger, F.floor((position - 1) / (size + 1)) + 1).otherwise(
        extra + F.floor((position - 1 - in_larger) / F.greatest(size, F.lit(1))) + 1).cast("int")


def spread_ntile(df: DataFrame, k: int, order: Sequence[str], out: str,
                 buckets: int | None = None) -> DataFrame:
    """Same tiles as ``ntile(k)`` over the whole table, for any number of rows."""
    numbered, sizes = _numbered(df, order, buckets)
    total = sizes.agg(F.sum("_size")).scalar()
    return (numbered.withColumn("_total", total)
            .withColumn(out, tile_of(F.col(_POSITION), F.col("_total"), k))
            .drop(_BUCKET, _POSITION, "_total"))


def ntile(df: DataFrame, k: int, order: Sequence[str], out: str, rows: int | None = None,
          max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
    """``ntile(k)`` over the whole table in a total order (end it with a unique column)."""
    rows = df.count() if rows is None else rows
    if rows <= max_task_rows:
        return df.withColumn(out, F.ntile(k).over(Window.orderBy(*sort_columns(order))))
    return spread_ntile(df, k, order, out, buckets_for(df, rows))


def spread_rank(df: DataFrame, group: Sequence[str], order: Sequence[str], tiebreak: Sequence[str],
                out: str, buckets: int | None = None) -> DataFrame:
    """``rank()`` by ``order`` within each group, a group spanning as many tasks as it needs.

    With all rows numbered by (group, order, tiebreak), the rank is the distance from the first
    position of the group to the first position of the row's tie. Both are taken within the
    bucket, except for a group or tie that crosses a bucket edge: it is the first or last of
    each bucket it touches, so at most two per bucket need a look beyond the bucket.
    """
    by = [*group, *sort_names(order)]
    numbered, _ = _numbered(df, [*group, *order, *tiebreak], buckets)
    # structs compare null with null as equal, as a window's partitions do
    numbered = (numbered.withColumn("_group", F.struct(*group)).withColumn("_tie", F.struct(*by)))
    edges = numbered.groupBy(_BUCKET).agg(
        *[f(F.struct("_group", "_tie"), _POSITION).alias(n)
          for f, n in ((F.min_by, "_first"), (F.max_by, "_last"))])
    edges = edges.select(F.explode(F.array("_first", "_last")).alias("_edge"))

    def edge_starts(level: str) -> DataFrame:
        at_edge = F.broadcast(edges.select(F.col(f"_edge.{level}").alias(level)).distinct())
        return F.broadcast(numbered.join(at_edge, level)
                           .groupBy(level).agg(F.min(_POSITION).alias(f"{level}_edge")))

    local = numbered
    for level, columns in (("_group", list(group)), ("_tie", by)):
        local = local.withColumn(f"{level}_start",
                                 F.min(_POSITION).over(Window.partitionBy(_BUCKET, *columns)))
    for level in ("_group", "_tie"):
        local = local.join(edge_starts(level), level, "left").withColumn(
            f"{level}_start", F.coalesce(f"{level}_edge", f"{level}_start"))
    return (local.withColumn(out, (F.col("_tie_start") - F.col("_group_start") + 1).cast("int"))
            .select(*df.columns, out))


def rank_in_group(df: DataFrame, group: Sequence[str], order: Sequence[str], tiebreak: Sequence[str],
                  out: str = "rank_in_group", max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
    """``rank()`` within each group; ``tiebreak`` only matters for spreading a hot tie."""
    if largest_group(df, group) <= max_task_rows:
        window = Window.partitionBy(*group).orderBy(*sort_columns(order))
        return df.withColumn(out, F.rank().over(window))
    return spread_rank(df, group, order, tiebreak, out)


def top_per_group(df: DataFrame, group: Sequence[str], value: str) -> DataFrame:
    """Rows holding the largest value of their group, ties kept, without sorting any group."""
    best = df.groupBy(*group).agg(F.max(value).alias(value))
    # a struct key matches null with null, so a null group is a group too
    key = F.struct(*group, value).alias("_key")
    return lookup_join(df.select("*", key), best.select(key), ["_key"], "left_semi").select(*df.columns)
