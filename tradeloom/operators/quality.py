"""Row validation and referential integrity, with the rejected rows kept."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tradeloom.operators.joins import broadcastable, lookup_join
from tradeloom.session import shuffles_dropped, written

REASONS = "_reject_reasons"
_LACKED = "_lacked"


def tag_rows(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the names of the rules each row breaks. A rule that is null counts as broken."""
    none = F.array().cast("array<string>")
    broken = F.concat(*[F.when(F.coalesce(rule, F.lit(False)), none).otherwise(F.array(F.lit(name)))
                        for name, rule in rules.items()])
    if REASONS in df.columns:
        broken = F.concat(F.col(REASONS), broken)
    return df.withColumn(REASONS, broken)


def accepted(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(REASONS) == 0).drop(REASONS)


def rejected(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.size(REASONS) > 0)


def split(df: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with reasons); together they are the input."""
    tagged = tag_rows(df, rules)
    return accepted(tagged), rejected(tagged)


def keep_known(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key exists in the dimension."""
    return lookup_join(fact, dimension.select(key), [key], "left_semi")


def orphans(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key is missing from the dimension, null keys included."""
    return lookup_join(fact, dimension.select(key), [key], "left_anti")


def tag_unknown(fact: DataFrame, dimension: DataFrame, key: str) -> DataFrame:
    """Like :func:`orphans`, but marks the rows, so one pass serves both sides of a split.

    ``dimension`` may also be what :func:`narrowed` made of it.
    """
    if _LACKED in dimension.columns:
        marked = lookup_join(fact, dimension, [key], "left")
        return tag_rows(marked, {f"unknown_{key}": F.col(key).isNotNull() & F.col(_LACKED).isNull()}).drop(_LACKED)
    marked = lookup_join(fact, _keys(dimension, key).withColumn("_known", F.lit(True)), [key], "left")
    return tag_rows(marked, {f"unknown_{key}": F.col("_known")}).drop("_known")


def _keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).filter(F.col(key).isNotNull()).distinct()


def narrowed(dimension: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """For :func:`tag_unknown`, the smaller of what tells the fact table's unknown keys.

    A dimension of too many keys to broadcast would have whole rows of facts shuffled. Of ``fact``, a stored table that
    holds the keys of all rows to be tagged, only the keys are; those that the dimension lacks take its place, unless they
    are too many as well.
    """
    known = _keys(dimension, key)
    if broadcastable(known):
        return dimension
    with shuffles_dropped(fact.sparkSession):
        lacked = written(_keys(fact, key).join(known, key, "left_anti"), "lacked")
    return lacked.withColumn(_LACKED, F.lit(True)) if broadcastable(lacked) else dimension


def land_split(tagged: DataFrame | Iterable[DataFrame], path: str, mode: str = "overwrite") -> tuple[DataFrame, DataFrame]:
    """Write a tagged table once, split by folder, and return (good, rejected) reads of it.

    The expensive work above the split runs one time; each reader opens only its folder. Of a table given in parts, one is
    written after the other, and the shuffle files of a part go before the next one starts.
    """
    side = F.when(F.size(REASONS) == 0, F.lit("accepted")).otherwise(F.lit("rejected"))
    for part in [tagged] if isinstance(tagged, DataFrame) else tagged:
        spark = part.sparkSession
        with shuffles_dropped(spark):
            part.withColumn("_side", side).write.mode(mode).option("compression", "zstd").partitionBy("_side").parquet(path)
        mode = "append"
    return read_split(spark, path)


def read_split(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    stored = spark.read.parquet(path)
    return (stored.filter("_side = 'accepted'").drop("_side", REASONS),
            stored.filter("_side = 'rejected'").drop("_side"))
