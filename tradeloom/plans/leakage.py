"""Revenue lost to abandoned carts, failed payments and returns."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.operators.joins import lookup_join


def session_losses(sessions: DataFrame, products: DataFrame) -> DataFrame:
    """Sessions that stopped at the cart or at a failed payment, per day.

    The loss is one list price of the session's first product. Sessions are counted per
    product before prices are looked up, so a product that holds most sessions is a few rows
    by then. A session whose product is unknown counts, but adds no loss.
    """
    stage = F.col("funnel_stage_reached")
    kind = (F.when(stage == "cart_abandoned", F.lit("abandoned_cart"))
            .when((stage == "payment_attempted") & (F.col("payment_status") == "failed"),
                  F.lit("failed_payment")))
    per_product = (sessions
                   .select(F.to_date("session_start").alias("event_date"),
                           kind.alias("leakage_type"),
                           F.col("first_product_id").alias("product_id"))
                   .filter("leakage_type IS NOT NULL")
                   .groupBy("event_date", "leakage_type", "product_id")
                   .agg(F.count(F.lit(1)).alias("_sessions")))
    priced = lookup_join(per_product, products.select("product_id", "list_price"), ["product_id"], "left")
    return priced.groupBy("event_date", "leakage_type").agg(
        F.sum("_sessions").alias("num_incidents"),
        F.round(F.sum(F.col("list_price") * F.col("_sessions").cast("decimal(18,0)")), 2)
        .alias("estimated_revenue_lost"))


def return_losses(orders: DataFrame) -> DataFrame:
    return (orders.filter(F.col("order_status") == "returned")
            .groupBy(F.to_date("return_timestamp").alias("event_date"))
            .agg(F.count(F.lit(1)).alias("num_incidents"),
                 F.round(F.sum("net_amount"), 2).alias("estimated_revenue_lost"))
            .select("event_date", F.lit("return").alias("leakage_type"), "num_incidents",
                    "estimated_revenue_lost"))


def revenue_leakage_daily(sessions: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    return session_losses(sessions, products).unionByName(return_losses(orders))


def leakage_totals(daily: DataFrame) -> DataFrame:
    return (daily.groupBy("leakage_type")
            .agg(F.sum("num_incidents").alias("total_incidents"),
                 F.round(F.sum("estimated_revenue_lost"), 2).alias("total_revenue_lost"))
            .orderBy(F.desc("total_revenue_lost"), "leakage_type"))
