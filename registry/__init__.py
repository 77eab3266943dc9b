"""The registered queries over the shared test tables, each next to its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tradeloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Money as double and instants as plain timestamps, the types the SQL side returns."""
    casts = {}
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            casts[f.name] = F.col(f.name).cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            casts[f.name] = F.col(f.name).cast("timestamp_ntz")
    return df.withColumns(casts) if casts else df


def register(sql: str | None = None):
    """Register a function under its own name, with the SQL that gives the same rows."""
    def add(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(query(tune(spark), sf_dir))

        QUERIES[query.__name__] = run
        if sql is not None:
            ORACLES[query.__name__] = sql
        return query
    return add
