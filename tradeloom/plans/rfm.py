"""Recency, frequency and spend scores, and the customer 360 table."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.functions.columns import tier
from tradeloom.operators.ranking import MAX_TASK_ROWS, buckets_for, ntile, spread_ntile
from tradeloom.schemas import MONEY
from tradeloom.session import written

# Score range, segment thresholds on the summed score, and what a customer
# without completed orders gets.
TILES = 5
SEGMENTS = [(13, "Champions"), (10, "Loyal Customers"), (7, "Potential Loyalists"), (5, "At Risk")]
LOWEST_SEGMENT = "Lost / Hibernating"
NEVER_ORDERED = {"recency_days": 9999, "frequency": 0, "rfm_score": 0, "rfm_segment": "Never Purchased"}

# "standard" gives the best customers 5; "reference" keeps the reversed scale some users
# have stored scores in, where the best customers get 1.
ORIENTATIONS = {
    "standard": {"r_score": "recency_days desc", "f_score": "frequency asc", "m_score": "monetary asc"},
    "reference": {"r_score": "recency_days asc", "f_score": "frequency desc", "m_score": "monetary desc"},
}


def as_of(orders: DataFrame) -> Column:
    """The newest order time over all orders, as a scalar subquery."""
    return orders.agg(F.max("order_timestamp")).scalar()


def measures(orders: DataFrame, as_of_time: datetime | None = None,
             frequency_includes_returns: bool = False) -> DataFrame:
    """Days since the last order, number of orders and net spend per customer.

    Only completed orders count. ``frequency_includes_returns`` lets returned ones count
    towards the frequency of customers who have a completed order.
    """
    today = as_of(orders) if as_of_time is None else F.lit(as_of_time)
    done = F.col("order_status") == "completed"
    counted = orders if frequency_includes_returns else orders.filter(done)
    per_customer = counted.groupBy("user_id").agg(
        F.max(F.when(done, F.col("order_timestamp"))).alias("_last"),
        F.count("order_id").alias("frequency"),
        F.sum(F.when(done, F.col("net_amount"))).cast(MONEY).alias("monetary"))
    if frequency_includes_returns:
        per_customer = per_customer.filter(F.col("_last").isNotNull())
    return (per_customer.withColumn("recency_days", F.datediff(today, "_last"))
            .select("user_id", "recency_days", "frequency", "monetary"))


def score(per_customer: DataFrame, orientation: str = "standard", method: str = "auto",
          max_task_rows: int = MAX_TASK_ROWS) -> DataFrame:
    """Quintile scores, their sum and the segment; ties are settled by ``user_id``.

    The measures are written first, since each score sorts them again. ``method`` is "auto"
    (a window while all customers fit one task), "window" or "spread".
    """
    if method not in ("auto", "window", "spread"):
        raise ValueError(f"unknown method {method!r}")
    scored = written(per_customer, "measures")
    rows = scored.count()
    for out, key in ORIENTATIONS[orientation].items():
        order = [key, "user_id"]
        if method == "spread":
            scored = spread_ntile(scored, TILES, order, out, buckets_for(scored, rows))
        else:
            scored = ntile(scored, TILES, order, out, rows, rows if method == "window" else max_task_rows)
    return with_segment(scored)


def with_segment(scored: DataFrame) -> DataFrame:
    return (scored.withColumn("rfm_score", F.col("r_score") + F.col("f_score") + F.col("m_score"))
            .withColumn("rfm_segment", tier("rfm_score", SEGMENTS, LOWEST_SEGMENT)))


def customer_360(users: DataFrame, scored: DataFrame) -> DataFrame:
    """All users with their scores; the three single scores of non-buyers stay null."""
    return (users.select("user_id", "name", "city", "state", "preferred_device")
            .join(scored, "user_id", "left")
            .fillna(NEVER_ORDERED)
            .withColumn("monetary", F.coalesce("monetary", F.lit(0).cast(MONEY)))
            .select("user_id", "name", "city", "state", "preferred_device", "recency_days",
                    "frequency", "monetary", "r_score", "f_score", "m_score", "rfm_score",
                    "rfm_segment"))


def segment_distribution(customers: DataFrame) -> DataFrame:
    return (customers.groupBy("rfm_segment").agg(F.count(F.lit(1)).alias("customers"))
            .orderBy(F.desc("customers"), "rfm_segment"))
