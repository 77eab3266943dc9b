"""Hot keys: finding them, and spreading their rows over many tasks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.operators.joins import BROADCAST_BYTES, measured_bytes
from tradeloom.session import written

HOT_SHARE = 0.001
_SALT, _SALTS, _ROW = "_salt", "_salts", "_row"


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def skew_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key, their share of all rows, and their ratio to the mean rows per key."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    overall = counts.agg(F.struct(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("keys"))).scalar()
    return counts.withColumn("_all", overall).select(
        *keys, "rows",
        (F.col("rows") / F.col("_all.rows")).alias("share"),
        (F.col("rows") * F.col("_all.keys") / F.col("_all.rows")).alias("ratio_to_mean"))


def hot_keys(df: DataFrame, keys: Sequence[str], min_share: float = HOT_SHARE) -> DataFrame:
    """Keys holding at least ``min_share`` of the rows, each with the salts it needs.

    At most ``1 / min_share`` rows whatever the data, so the result may be broadcast. A key
    gets as many salts as shuffle partitions its rows would fill.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    total = counts.agg(F.sum("_rows")).scalar()
    wanted = F.ceil(F.col("_rows") / total * F.lit(shuffle_partitions(df))).cast("int")
    return (counts.filter(F.col("_rows") >= total * F.lit(min_share))
            .select(*keys, F.greatest(wanted, F.lit(2)).alias(_SALTS)))


def _salt(columns: Sequence[str], salts: Column) -> Column:
    # a hash of the row, not rand(): a retried task must give a row the same salt
    return F.pmod(F.xxhash64(*[F.col(c) for c in columns]), salts).cast("int")


def _free(name: str, *frames: DataFrame) -> str:
    """A column name that none of the frames has."""
    taken = {c.lower() for df in frames for c in df.columns}
    while name in taken:
        name += "_"
    return name


def salted_join(fact: DataFrame, dimension: DataFrame, on: Sequence[str], how: str = "inner",
                hot: DataFrame | None = None, salt_on: Sequence[str] | None = None,
                min_share: float = HOT_SHARE) -> DataFrame:
    """Equi-join whose hot fact keys are spread over many tasks.

    Rows of other keys take the ordinary join; if no key is hot that is all, and nothing is written. Rows of a hot key get a
    salt from the ``salt_on`` columns, and the dimension rows of that key are repeated once per salt. By default only the rows
    of hot keys are written, once, with a number each, and salted by that, so that equal rows are spread as well; columns that
    tell rows apart save the writing. ``hot`` defaults to :func:`hot_keys` of the fact, found by one more pass over it. Null
    keys match nothing: their rows take no part in the join, and are added where the kind of join keeps them.
    """
    on, columns = list(on), fact.columns
    if how in ("right", "full", "outer"):
        kept = "inner" if how == "right" else "left"
        matched = salted_join(fact, dimension, on, kept, hot, salt_on, min_share)
        # only the rows without a match are left to add;
        # distinct collapses a hot key before the shuffle, so the other half needs no salt
        alone = dimension.join(fact.select(*on).distinct(), on, "left_anti")
        return matched.unionByName(alone, allowMissingColumns=True)
    if hot is None:
        hot = written(hot_keys(fact, on, min_share), "hot-keys")
    elif measured_bytes(hot.select(*on)) > BROADCAST_BYTES:
        raise ValueError("hot keys are broadcast, and these are too many")
    if _SALTS not in hot.columns:
        hot = hot.withColumn(_SALTS, F.lit(shuffle_partitions(fact)))
    out = columns if how in ("left_semi", "left_anti") else [*columns, *[c for c in dimension.columns if c not in on]]
    missing = reduce(or_, [F.col(c).isNull() for c in on])
    named = fact.where(~missing)
    if hot.isEmpty():
        joined = named.join(dimension, on, how).select(*out)
    else:
        salt, salts, row = (_free(name, fact, dimension) for name in (_SALT, _SALTS, _ROW))
        hot = F.broadcast(hot.select(*on, F.col(_SALTS).alias(salts)))
        cold = named.join(hot, on, "left_anti").join(dimension, on, how)
        spread = named.join(hot, on)
        if not salt_on:
            # stored, so that a retried task finds the same numbers
            spread = written(spread.withColumn(row, F.monotonically_increasing_id()), "hot-rows")
        spread = spread.withColumn(salt, _salt(salt_on or [row], F.col(salts)))
        repeated = dimension.join(hot, on).withColumn(salt, F.explode(F.sequence(F.lit(0), F.col(salts) - 1))).drop(salts)
        joined = cold.select(*out).unionByName(spread.join(repeated, [*on, salt], how).select(*out))
    if how in ("left", "left_outer", "leftouter", "left_anti"):
        joined = joined.unionByName(fact.where(missing), allowMissingColumns=True)
    return joined


def salted_agg(df: DataFrame, keys: Sequence[str], measures: dict[str, tuple[str, str]], salts: int,
               salt_on: Sequence[str]) -> DataFrame:
    """Two-phase aggregate: per (key, salt), then per key.

    ``measures`` maps an output name to ``(sum | count | min | max, column)``. Spark already
    combines these on the map side; the salt additionally bounds the rows of a hot key
    that meet in one reduce task.
    """
    first = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}
    second = {**first, "count": F.sum}
    partial = (df.withColumn(_SALT, _salt(salt_on, F.lit(salts)))
               .groupBy(*keys, _SALT)
               .agg(*[first[kind](c).alias(name) for name, (kind, c) in measures.items()]))
    return partial.groupBy(*keys).agg(
        *[second[kind](name).alias(name) for name, (kind, _) in measures.items()])
