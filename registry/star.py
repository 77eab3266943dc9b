"""The shared test tables seen as users, products, order lines, clicks and employees.

Each mapping has its SQL twin, a common table expression for the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.functions.columns import as_discount, as_money, net_amount
from tradeloom.operators.dedup import dedup_latest
from tradeloom.operators.joins import lookup_join
from tradeloom.plans.sessions import stitch_sessions
from tradeloom.sources.files import read_parquet, with_utc_timestamps

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate desc"]
LINE_TIEBREAK = ["l_partkey", "l_suppkey", "l_quantity desc", "l_extendedprice desc", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus"]

EVENT_NAMES = {"view": "view", "click": "add_to_cart", "signup": "checkout_start",
               "error": "payment_attempt", "purchase": "purchase"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return with_utc_timestamps(read_parquet(spark, f"{sf_dir}/{name}.parquet"))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations with their region: 25 rows at every scale."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, where = table(spark, sf_dir, "customer"), places(spark, sf_dir)
    return customer.join(where, customer.c_nationkey == where.n_nationkey).select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit("@X.COM ")).alias("email"),
        F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.col("c_mktsegment").alias("preferred_device"), as_money("c_acctbal").alias("balance"))


USERS = """users AS (
  SELECT c_custkey AS user_id, c_name AS name, '  ' || upper(c_name) || '@X.COM ' AS email, n_name AS city,
         r_name AS state, c_mktsegment AS preferred_device, CAST(c_acctbal AS DECIMAL(18,2)) AS balance
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users, and the suppliers as users below zero: they never order anything."""
    supplier, where = table(spark, sf_dir, "supplier"), places(spark, sf_dir)
    quiet = supplier.join(where, supplier.s_nationkey == where.n_nationkey).select(
        (F.lit(-1) - F.col("s_suppkey")).alias("user_id"), F.col("s_name").alias("name"),
        F.lit(None).cast("string").alias("email"), F.col("n_name").alias("city"), F.col("r_name").alias("state"),
        F.lit("NONE").alias("preferred_device"), as_money("s_acctbal").alias("balance"))
    return users(spark, sf_dir).unionByName(quiet)


ACCOUNTS = USERS + """, accounts AS (
  SELECT * FROM users UNION ALL
  SELECT -1 - s_suppkey, s_name, NULL, n_name, r_name, 'NONE', CAST(s_acctbal AS DECIMAL(18,2))
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("sub_category"),
        F.col("p_brand").alias("brand"), as_money("p_retailprice").alias("list_price"),
        F.col("p_size").alias("size"))


PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category, p_brand AS sub_category,
         p_brand AS brand, CAST(p_retailprice AS DECIMAL(18,2)) AS list_price, p_size AS size FROM part)"""


def clean_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_latest(table(spark, sf_dir, "lineitem"), LINE_KEY, LINE_ORDER, LINE_TIEBREAK)


CLEAN_LINES = f"""clean_lines AS (
  SELECT * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY {', '.join(LINE_KEY)}
                             ORDER BY {', '.join(LINE_ORDER + LINE_TIEBREAK)}) = 1)"""


def lines_of(lineitem: DataFrame, orders: DataFrame, *more: str) -> DataFrame:
    """Order lines under the names of the order table, with the header's user and date.

    ``more`` names further columns to keep.
    """
    returned = F.col("l_returnflag") == "R"
    lines = lineitem.select(
        F.col("l_orderkey").alias("order_id"), F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("product_id"), F.col("l_quantity").cast("int").alias("quantity"),
        as_money("l_extendedprice").alias("unit_price"), as_discount("l_discount").alias("discount_pct"),
        F.when(returned, F.lit("returned")).otherwise(F.lit("completed")).alias("order_status"),
        F.when(returned, F.col("l_shipdate")).alias("return_timestamp"), *more)
    headers = orders.select(F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
                            F.col("o_orderdate").alias("order_timestamp"))
    return lookup_join(lines, headers, ["order_id"])


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lines_of(clean_lines(spark, sf_dir), table(spark, sf_dir, "orders"))
    return lines.withColumn("net_amount", net_amount("quantity", "unit_price", "discount_pct"))


NET_AMOUNT = """CAST(round(CAST(l_quantity AS DECIMAL(10,0)) * CAST(l_extendedprice AS DECIMAL(18,2))
         * (CAST(1 AS DECIMAL(5,4)) - CAST(l_discount AS DECIMAL(5,4))), 2) AS DECIMAL(18,2))"""
ORDER_LINES = CLEAN_LINES + f""", order_lines AS (
  SELECT l_orderkey AS order_id, l_linenumber AS line_no, o_custkey AS user_id, l_partkey AS product_id,
         o_orderdate AS order_timestamp, CAST(l_quantity AS INTEGER) AS quantity,
         CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price, CAST(l_discount AS DECIMAL(5,4)) AS discount_pct,
         CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'completed' END AS order_status,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS return_timestamp,
         {NET_AMOUNT} AS net_amount
  FROM clean_lines JOIN orders ON l_orderkey = o_orderkey)"""


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as clickstream: a session is a user's day."""
    events = table(spark, sf_dir, "events")
    parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1))).scalar()
    kind = F.col("event_type")
    renamed = F.lit(None).cast("string")
    for raw, name in EVENT_NAMES.items():
        renamed = F.when(kind == raw, F.lit(name)).otherwise(renamed)
    devices = F.array(F.lit("mobile"), F.lit("desktop"), F.lit("tablet"))
    return events.select(
        "event_id",
        F.concat_ws("-", F.col("user_id").cast("string"), F.to_date("ts").cast("string")).alias("session_id"),
        "user_id", F.get(devices, (F.col("user_id") % 3).cast("int")).alias("device_type"),
        renamed.alias("event_type"), F.col("ts").alias("event_timestamp"),
        (F.col("event_id") % parts).alias("product_id"),
        F.when(kind == "error", F.lit("failed")).when(kind == "purchase", F.lit("success")).alias("payment_status"))


CLICKS = """clicks AS (
  SELECT event_id, user_id || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id, user_id,
         CASE user_id % 3 WHEN 0 THEN 'mobile' WHEN 1 THEN 'desktop' ELSE 'tablet' END AS device_type,
         CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'add_to_cart' WHEN 'signup' THEN 'checkout_start'
              WHEN 'error' THEN 'payment_attempt' WHEN 'purchase' THEN 'purchase' END AS event_type,
         ts AS event_timestamp, event_id % (SELECT count(*) FROM part) AS product_id,
         CASE event_type WHEN 'error' THEN 'failed' WHEN 'purchase' THEN 'success' END AS payment_status
  FROM events)"""


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stitch_sessions(clicks(spark, sf_dir))


SESSIONS = CLICKS + """, sessions AS (
  SELECT session_id, user_id, min(event_timestamp) AS session_start, max(event_timestamp) AS session_end,
         count(*) AS num_events, arg_min(device_type, (event_timestamp, event_id)) AS device_type,
         arg_min(product_id, (event_timestamp, event_id)) AS first_product_id,
         max(payment_status) FILTER (event_type = 'payment_attempt') AS payment_status,
         CASE max(CASE event_type WHEN 'view' THEN 1 WHEN 'add_to_cart' THEN 2 WHEN 'checkout_start' THEN 3
                                  WHEN 'payment_attempt' THEN 4 WHEN 'purchase' THEN 5 END)
              WHEN 5 THEN 'purchased' WHEN 4 THEN 'payment_attempted' WHEN 3 THEN 'checkout_started'
              WHEN 2 THEN 'cart_abandoned' ELSE 'browse_only' END AS funnel_stage_reached,
         CAST(floor(epoch(max(event_timestamp))) AS BIGINT) - CAST(floor(epoch(min(event_timestamp))) AS BIGINT)
           AS session_duration_secs
  FROM clicks GROUP BY session_id, user_id)"""


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, where = table(spark, sf_dir, "supplier"), places(spark, sf_dir)
    return supplier.join(where, supplier.s_nationkey == where.n_nationkey).select(
        F.col("s_suppkey").alias("emp_id"), F.col("s_name").alias("name"), F.col("r_name").alias("department"),
        as_money("s_acctbal").alias("salary"), F.col("n_name").alias("city"))


EMPLOYEES = """employees AS (
  SELECT s_suppkey AS emp_id, s_name AS name, r_name AS department, CAST(s_acctbal AS DECIMAL(18,2)) AS salary,
         n_name AS city
  FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""
