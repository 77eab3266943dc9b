"""Revenue tables and the aggregates a dashboard shows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tradeloom.operators.joins import lookup_join


def daily_category_rollup(orders: DataFrame, products: DataFrame) -> DataFrame:
    """Orders, units and revenue of completed orders per day, category and sub-category."""
    sold = (orders.filter(F.col("order_status") == "completed")
            .select("order_id", "product_id", "quantity", "net_amount",
                    F.to_date("order_timestamp").alias("order_date")))
    labels = products.select("product_id", "category", "sub_category")
    # one row per product and day meets the products, however many lines sold it
    per_product = (sold.groupBy("order_date", "product_id")
                   .agg(F.count("order_id").alias("num_orders"), F.sum("quantity").alias("units_sold"),
                        F.sum("net_amount").alias("revenue")))
    return (lookup_join(per_product, labels, ["product_id"])
            .groupBy("order_date", "category", "sub_category")
            .agg(F.sum("num_orders").alias("num_orders"),
                 F.sum("units_sold").alias("units_sold"),
                 F.round(F.sum("revenue"), 2).alias("revenue")))


def daily_revenue(rollup: DataFrame) -> DataFrame:
    return rollup.groupBy("order_date", "category").agg(F.sum("revenue").alias("revenue"))


def category_totals(rollup: DataFrame) -> DataFrame:
    return (rollup.groupBy("category").agg(F.sum("revenue").alias("revenue"))
            .orderBy(F.desc("revenue"), "category"))


def leakage_trend(leakage: DataFrame) -> DataFrame:
    return leakage.groupBy("event_date", "leakage_type").agg(
        F.sum("estimated_revenue_lost").alias("estimated_revenue_lost"))


def segment_names(customers: DataFrame) -> DataFrame:
    """The values a segment filter offers."""
    return customers.select("rfm_segment").distinct().orderBy("rfm_segment")


def in_segments(customers: DataFrame, segments: list[str]) -> DataFrame:
    """Customers of the chosen segments; no choice means all."""
    return customers.filter(F.col("rfm_segment").isin(*segments)) if segments else customers


def kpis(customers: DataFrame, leakage: DataFrame) -> DataFrame:
    """One row: customers, total revenue, revenue lost, Champions."""
    lost = leakage.agg(F.sum("estimated_revenue_lost")).scalar()
    champion = F.col("rfm_segment") == "Champions"
    return (customers.agg(F.count(F.lit(1)).alias("customers"),
                          F.sum("monetary").alias("total_revenue"),
                          F.count(F.when(champion, 1)).alias("champions"))
            .select("customers", "total_revenue", lost.alias("revenue_lost"), "champions"))
