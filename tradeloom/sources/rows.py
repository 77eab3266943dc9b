"""Tables from literal rows and from number sequences."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def from_rows(spark: SparkSession, rows: Iterable[tuple], schema: T.StructType | str) -> DataFrame:
    """A small literal table; the schema is always stated, never guessed from the rows."""
    return spark.createDataFrame(list(rows), schema)


def sequence(spark: SparkSession, start: int, end: int, name: str = "id") -> DataFrame:
    """The whole numbers ``start`` .. ``end - 1``, made in parallel."""
    return spark.range(start, end).withColumnRenamed("id", name)
