"""The whole batch: raw files to bronze, silver, gold, segments and BI copies.

    python -m tradeloom.plans.daily_run --base <folder> --batch <id>

Each step reads the written tables of the step before, so no step computes another's work
again and a lost executor costs one task, not a chain of steps.
"""

from __future__ import annotations

import argparse
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from tradeloom import schemas
from tradeloom.operators import quality
from tradeloom.plans import increments, leakage, rfm, rollups, segments, sessions, silver
from tradeloom.session import build_session, passing_tables
from tradeloom.sources import files
from tradeloom.sources.versioned import VersionedTable

RAW = {"users": schemas.USERS_RAW, "products": schemas.PRODUCTS_RAW, "orders": schemas.ORDERS_RAW,
       "clickstream": schemas.CLICKS_RAW}
DIMENSIONS = {"users": silver.users, "products": silver.products}
FACTS = {"orders": (silver.orders, "order_id", "order_timestamp"), "clickstream": (silver.clickstream, "event_id", "event_timestamp")}
GOLD = ("customer_360", "daily_category_rollup", "revenue_leakage_daily", "customer_segments_kmeans")


class Tables:
    """Paths of the layers below one base folder."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.base}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return self.spark.read.parquet(self.path(layer, name))

    def arrived(self, name: str, batch_id: str) -> DataFrame:
        """The rows one batch landed; no other folder is read. Batch ids are text, whatever they look like."""
        landed = self.read("bronze", name).schema
        as_text = T.StructType([T.StructField(f.name, T.StringType()) if f.name == "_batch_id" else f for f in landed])
        return (self.spark.read.schema(as_text).parquet(self.path("bronze", name))
                .filter(F.col("_batch_id") == batch_id).drop("_batch_id"))

    def dimension(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path("silver", name), [f"{name[:-1]}_id"])

    def current(self, name: str) -> DataFrame:
        """Users or products as of this run, merged once for all the joins that need them."""
        return self.read("silver", f"{name}_current")

    def fact(self, name: str) -> DataFrame:
        return increments.read_sides(self.spark, self.path("silver", name))[0].drop(*silver.ORIGIN)

    def rejects(self, name: str) -> DataFrame:
        """Rejected rows with their reasons, for users and products of all batches."""
        if name in DIMENSIONS:
            return quality.read_split(self.spark, self.path("silver_checked", name))[1]
        return increments.read_sides(self.spark, self.path("silver", name))[1]


def land(tables: Tables, name: str, batch_id: str) -> int:
    """Append the raw files of one table as they are; returns the rows landed."""
    read = files.read_json if name == "clickstream" else files.read_csv
    return files.ingest(read(tables.spark, tables.path("raw", name), RAW[name]), tables.path("bronze", name), batch_id)


def to_bronze(tables: Tables, batch_id: str) -> dict[str, int]:
    """Append the raw files as they are; returns the rows landed per table."""
    return {name: land(tables, name, batch_id) for name in RAW}


def to_silver(tables: Tables, batch_id: str) -> None:
    """Upsert the batch's users and products, clean its facts and merge them into the days they touch; stitch the sessions."""
    for name, clean in DIMENSIONS.items():
        # the folder name escapes what a path can't hold, as Spark does for its own partitions
        good, _ = quality.land_split(clean(tables.arrived(name, batch_id)),
                                     f"{tables.path('silver_checked', name)}/_batch_id={quote(batch_id, safe='')}")
        good, key = good.drop(*silver.ORIGIN), f"{name[:-1]}_id"
        tables.dimension(name).upsert(good, [key], [c for c in good.columns if c != key])
        files.write_results(tables.dimension(name).read(), tables.path("silver", f"{name}_current"))
    users, products = tables.current("users"), tables.current("products")
    for name, (clean, key, moment) in FACTS.items():
        increments.apply_batch(tables.spark, tables.path("silver", name), clean(tables.arrived(name, batch_id), users, products),
                               [key], F.col(moment), batch_id, lambda rows: silver.tag_known(rows, users, products))
    files.write_results(sessions.stitch_sessions(tables.fact("clickstream")), tables.path("silver", "sessions"))


def to_customer_360(tables: Tables) -> None:
    scored = rfm.score(rfm.measures(tables.fact("orders")))
    files.write_results(rfm.customer_360(tables.current("users"), scored),
                        tables.path("gold", "customer_360"))


def to_category_rollup(tables: Tables) -> None:
    rollup = rollups.daily_category_rollup(tables.fact("orders"), tables.current("products"))
    # a day is a few rows by now: one file per day instead of one per task and day
    files.write_results(rollup.repartition("order_date"), tables.path("gold", "daily_category_rollup"),
                        partition_by=["order_date"])


def to_leakage(tables: Tables) -> None:
    daily = leakage.revenue_leakage_daily(tables.read("silver", "sessions"), tables.current("products"),
                                          tables.fact("orders"))
    files.write_results(daily, tables.path("gold", "revenue_leakage_daily"), partition_by=["leakage_type"])


def to_segments(tables: Tables, k: int = segments.CLUSTERS) -> None:
    features = segments.customer_features(tables.read("gold", "customer_360"), tables.read("silver", "sessions"))
    files.write_results(segments.cluster_customers(features, k), tables.path("gold", "customer_segments_kmeans"))


def to_exports(tables: Tables) -> dict[str, int]:
    return {name: files.export_for_bi(tables.read("gold", name), f"{tables.base}/exports", name) for name in GOLD}


def run(spark: SparkSession, base: str, batch_id: str) -> dict[str, int]:
    """All steps for one batch; returns the rows exported per gold table.

    Gold tables that don't need each other run at the same time in one session.
    """
    tables = Tables(spark, base)
    with passing_tables(spark, "daily-run"):
        to_bronze(tables, batch_id)
        to_silver(tables, batch_id)
        with ThreadPoolExecutor(max_workers=3) as side_by_side:
            for step in [side_by_side.submit(copy_context().run, job, tables)
                         for job in (to_customer_360, to_category_rollup, to_leakage)]:
                step.result()
        to_segments(tables)
        return to_exports(tables)


def main(argv: list[str] | None = None) -> None:
    arguments = argparse.ArgumentParser(description="Bronze, silver and gold tables of one batch")
    arguments.add_argument("--base", required=True)
    arguments.add_argument("--batch", required=True)
    given = arguments.parse_args(argv)
    spark = build_session("daily-run")
    run(spark, given.base, given.batch)


if __name__ == "__main__":
    main()
