"""Joins of a large table with a smaller one."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

BROADCAST_BYTES = 64 * 1024 * 1024
# inputs larger than this many times the limit are not read to measure a dimension
FAR_BEYOND = 100


def _value_bytes(schema: T.StructType, prefix: str = "") -> Column | None:
    total = F.lit(0).cast("long")
    for f in schema.fields:
        name = f"{prefix}`{f.name}`"
        if isinstance(f.dataType, T.StructType):
            part = _value_bytes(f.dataType, f"{name}.")
        elif isinstance(f.dataType, (T.StringType, T.BinaryType)):
            part = F.coalesce(F.octet_length(F.col(name)), F.lit(0)) + F.lit(16)
        elif isinstance(f.dataType, (T.ArrayType, T.MapType, T.VariantType)):
            part = None
        else:
            part = F.lit(16)
        if part is None:
            return None
        total = total + part
    return total


def measured_bytes(df: DataFrame) -> int | None:
    """Bytes of the table's values, from one aggregate over it; None if a column can't tell."""
    per_row = _value_bytes(df.schema)
    return None if per_row is None else df.agg(F.sum(per_row)).first()[0] or 0


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files and tables a table is computed from, as the planner knows them.

    Reads no data. (The planner's estimate for the result is no use here: it takes a join
    for as large as the product of its sides.)
    """
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    return sum(int(leaves.apply(i).stats().sizeInBytes()) for i in range(leaves.size()))


def broadcastable(dimension: DataFrame, max_broadcast_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether :func:`lookup_join` would broadcast the table."""
    if input_bytes(dimension) > FAR_BEYOND * max_broadcast_bytes:
        return False
    size = measured_bytes(dimension)
    return size is not None and size <= max_broadcast_bytes


def lookup_join(fact: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner",
                max_broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join facts with a dimension of unknown size (inner, left, left_semi or left_anti).

    The dimension's bytes are measured. Within the limit it is broadcast, and the fact table
    is not shuffled at all. Beyond it both sides are shuffled and sorted, and AQE splits the
    partitions of hot fact keys at run time. A dimension made from far more than the limit is
    not measured, since reading all that just for its size would cost too much; AQE then
    still broadcasts it if the rows turn out to be few.
    """
    if input_bytes(dimension) > FAR_BEYOND * max_broadcast_bytes:
        return fact.join(dimension, list(on), how)
    size = measured_bytes(dimension)
    small = size is not None and size <= max_broadcast_bytes
    return fact.join(F.broadcast(dimension) if small else dimension.hint("merge"), list(on), how)


def keep_all_of_right(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Right outer join with ``left`` as the large, possibly skewed side.

    As a right join, no hot key of the left side could be split. The matches can, and for the
    rows without a match the distinct keys of the left side are enough.
    """
    return lookup_join(left, right, on).unionByName(_unmatched(left, right, on), allowMissingColumns=True)


def keep_all(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """Full outer join with ``left`` as the large, possibly skewed side."""
    return lookup_join(left, right, on, "left").unionByName(_unmatched(left, right, on), allowMissingColumns=True)


def _unmatched(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return right.join(left.select(*on).distinct(), list(on), "left_anti")
