"""Aggregates that take more than one line of ``groupBy().agg()``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def word_count(df: DataFrame, text: str = "value") -> DataFrame:
    """Occurrences of each space-separated token; counted per task before the shuffle."""
    return (df.select(F.explode(F.split(text, " ")).alias("token")).filter("token <> ''")
            .groupBy("token").agg(F.count(F.lit(1)).alias("n")))


def top_words(df: DataFrame, text: str = "value", k: int = 20) -> DataFrame:
    return word_count(df, text).orderBy(F.desc("n"), "token").limit(k)


def describe_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """count, mean, sample stddev, min and max of each column, in one pass; a row per column."""
    stats = df.agg(*[
        F.struct(F.lit(c).alias("column"), F.count(c).alias("count"),
                 F.avg(F.col(c).cast("double")).alias("mean"),
                 F.stddev_samp(F.col(c).cast("double")).alias("stddev"),
                 F.min(F.col(c).cast("double")).alias("min"),
                 F.max(F.col(c).cast("double")).alias("max")).alias(c)
        for c in columns])
    return stats.select(F.inline(F.array(*columns)))
