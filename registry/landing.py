"""Raw files of all four tables, some of their lines damaged: landed, cleaned, and merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from registry import register
from registry.layers import KNOWN, _known
from registry.star import (CLICKS, LINE_ORDER, LINE_TIEBREAK, NET_AMOUNT, ORDER_LINES, PRODUCTS, USERS, clicks, lines_of, products, table,
                           users)
from tradeloom.operators import quality
from tradeloom.operators.ordering import sort_names
from tradeloom.plans import daily_run, increments, silver
from tradeloom.schemas import CLICKS_RAW, ORDERS_RAW, PRODUCTS_RAW, USERS_RAW
from tradeloom.session import scratch_path, shuffles_dropped
from tradeloom.sources import paths
from tradeloom.sources.files import CORRUPT

BATCH = "2024-05-01T10"
# a quarter of the bytes; packed files can't be split, so there are more of them
PACKED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": 1_000_000}
SCHEMAS = {"users": USERS_RAW, "products": PRODUCTS_RAW, "orders": ORDERS_RAW, "clickstream": CLICKS_RAW}


def _as_text(df: DataFrame, name: str) -> DataFrame:
    columns = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) if df.schema[c].dataType.typeName().startswith("timestamp")
               else F.col(c).cast("string").alias(c) for c in SCHEMAS[name].fieldNames()]
    return df.select(*columns)


def _orders(spark: SparkSession, d: str) -> DataFrame:
    lines = lines_of(table(spark, d, "lineitem"), table(spark, d, "orders"))
    return lines.withColumns({
        "session_id": F.concat(F.lit("s"), F.col("order_id").cast("string")), "payment_method": F.lit("card"),
        "order_id": F.concat_ws("-", F.col("order_id").cast("string"), F.col("line_no").cast("string"))})


def _raw_files(spark: SparkSession, d: str) -> daily_run.Tables:
    """Whole tables as raw files, landed one by one: CSV with a header, clicks as JSON lines. Damaged lines lack columns, have too many, or break off."""
    tables = daily_run.Tables(spark, scratch_path(spark, "raw-files"))
    people, things = users(spark, d), products(spark, d)
    good = {"users": people.withColumns({"email": F.trim("email"), "signup_date": F.date_add(
                F.lit("2020-01-01").cast("date"), (F.col("user_id") % 1000).cast("int"))}),
            "products": things, "orders": _orders(spark, d), "clickstream": clicks(spark, d)}
    ids = lambda c: F.col(c).cast("string").alias(c)
    damaged = {"users": people.where("balance < 0").select(ids("user_id"), "name", *[F.lit(x).alias(x) for x in "pqrstuv"]),
               "products": things.where("size = 1").select(ids("product_id"), F.lit("short").alias("product_name")),
               "orders": _orders(spark, d).where("line_no = 7").select("order_id", F.lit("short").alias("session_id")),
               "clickstream": clicks(spark, d).where("event_type = 'purchase'").select(
                   F.concat(F.lit('{"event_id": "'), F.col("event_id").cast("string"), F.lit('", "session_id":')).alias("value"))}
    for name in SCHEMAS:
        path, lines = tables.path("raw", name), _as_text(good[name], name)
        with shuffles_dropped(spark):
            if name == "clickstream":
                lines.write.options(**PACKED).json(path)
                damaged[name].write.mode("append").options(**PACKED).text(path)
            else:
                lines.write.options(header=True, **PACKED).csv(path)
                damaged[name].write.mode("append").options(header=True, **PACKED).csv(path)
        daily_run.land(tables, name, BATCH)
        paths.remove(spark, path)  # all of it has landed
    return tables


RAW = f"""{USERS}, {PRODUCTS}, {CLICKS},
raw_orders AS (
  SELECT l_orderkey || '-' || l_linenumber AS order_id, 's' || l_orderkey AS session_id, o_custkey AS user_id, l_partkey AS product_id,
         o_orderdate AS order_timestamp, CAST(l_quantity AS INTEGER) AS quantity, CAST(l_extendedprice AS DECIMAL(18,2)) AS unit_price,
         CAST(l_discount AS DECIMAL(5,4)) AS discount_pct, CASE WHEN l_returnflag = 'R' THEN 'returned' ELSE 'completed' END AS order_status,
         CASE WHEN l_returnflag = 'R' THEN l_shipdate END AS return_timestamp, l_linenumber AS line_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
TIME = "strftime({0}, '%Y-%m-%d %H:%M:%S')"


@register(f"""WITH {RAW}
SELECT 'users' AS source, concat_ws('|', user_id, name, trim(email), city, state,
       strftime(DATE '2020-01-01' + CAST(user_id % 1000 AS INTEGER), '%Y-%m-%d'), preferred_device) AS line, false AS malformed FROM users
UNION ALL SELECT 'users', user_id || ',' || name || ',p,q,r,s,t,u,v', true FROM users WHERE balance < 0
UNION ALL SELECT 'products', concat_ws('|', product_id, product_name, category, sub_category, brand, list_price), false FROM products
UNION ALL SELECT 'products', product_id || ',short', true FROM products WHERE size = 1
UNION ALL SELECT 'orders', concat_ws('|', order_id, session_id, user_id, product_id, {TIME.format('order_timestamp')}, quantity, unit_price, discount_pct,
                           'card', order_status, {TIME.format('return_timestamp')}), false FROM raw_orders
UNION ALL SELECT 'orders', order_id || ',short', true FROM raw_orders WHERE line_no = 7
UNION ALL SELECT 'clickstream', concat_ws('|', event_id, session_id, user_id, device_type, event_type, {TIME.format('event_timestamp')}, product_id,
                           payment_status), false FROM clicks
UNION ALL SELECT 'clickstream', '{{"event_id": "' || event_id || '", "session_id":', true FROM clicks WHERE event_type = 'purchase'""")
def bronze_four_tables(spark, d):
    """Every line of the four raw tables as it landed."""
    tables, landed = _raw_files(spark, d), []
    for name, schema in SCHEMAS.items():
        rows = tables.arrived(name, BATCH).where("_ingested_at IS NOT NULL AND _source_file IS NOT NULL")
        landed.append(rows.select(F.lit(name).alias("source"), F.coalesce(CORRUPT, F.concat_ws("|", *schema.fieldNames())).alias("line"),
                                  F.col(CORRUPT).isNotNull().alias("malformed")))
    whole = landed[0]
    for rows in landed[1:]:
        whole = whole.unionByName(rows)
    return whole


@register(f"""WITH {RAW},
known AS (SELECT event_id FROM clicks SEMI JOIN users USING (user_id) SEMI JOIN products USING (product_id)),
counts AS (
  SELECT 'users' AS source, count(*) AS good, count(*) AS lines, count(*) FILTER (balance < 0) AS malformed FROM users
  UNION ALL SELECT 'products', count(*), count(*), count(*) FILTER (size = 1) FROM products
  UNION ALL SELECT 'orders', count(DISTINCT order_id), count(*), count(*) FILTER (line_no = 7) FROM raw_orders
  UNION ALL SELECT 'clickstream', (SELECT count(*) FROM known), count(*), count(*) FILTER (event_type = 'purchase') FROM clicks)
SELECT source, lines + malformed AS landed, good AS accepted, CASE source WHEN 'clickstream' THEN lines - good ELSE 0 END + malformed AS rejected,
       malformed, CASE source WHEN 'orders' THEN lines - good ELSE 0 END AS duplicates FROM counts""")
def landing_report(spark, d):
    """Where every landed line went: each is accepted, rejected or the older copy of another."""
    tables, checked = _raw_files(spark, d), {}
    for name, clean in daily_run.DIMENSIONS.items():
        parts = silver.by_key(tables.arrived(name, BATCH), [f"{name[:-1]}_id"])
        checked[name] = quality.land_split((clean(part) for part in parts), tables.path("checked", name))
    for name, (clean, key, _) in daily_run.FACTS.items():
        arrived = tables.arrived(name, BATCH)
        known = [quality.narrowed(checked[d][0], arrived, f"{d[:-1]}_id") for d in daily_run.DIMENSIONS]
        checked[name] = quality.land_split((clean(part, *known) for part in silver.by_key(arrived, [key])), tables.path("checked", name))
    report = None
    for name, (good, bad) in checked.items():
        counts = (tables.arrived(name, BATCH).agg(F.count(F.lit(1)).alias("landed")).withColumn("source", F.lit(name))
                  .join(good.agg(F.count(F.lit(1)).alias("accepted")).withColumn("source", F.lit(name)), "source")
                  .join(bad.agg(F.count(F.lit(1)).alias("rejected"), F.count_if(F.array_contains(quality.REASONS, silver.MALFORMED)).alias("malformed"))
                        .withColumn("source", F.lit(name)), "source")
                  .withColumn("duplicates", F.col("landed") - F.col("accepted") - F.col("rejected")))
        report = counts if report is None else report.unionByName(counts)
    return report


@register(f"""WITH {ORDER_LINES}, {KNOWN}, known_later AS (SELECT p_partkey AS product_id FROM part WHERE p_size <= 40),
lines AS (
  SELECT order_id, line_no, user_id, product_id, order_timestamp, CASE line_no WHEN 3 THEN quantity + 1 ELSE quantity END AS quantity,
         unit_price, discount_pct, CASE WHEN line_no > 2 THEN 'b2' ELSE 'b1' END AS batch FROM order_lines WHERE line_no <= 4),
judged AS (
  SELECT order_id, line_no, e.user_id, e.product_id, order_timestamp, quantity, CAST(unit_price AS DOUBLE) AS unit_price, batch,
         CAST({NET_AMOUNT.replace('l_quantity', 'quantity').replace('l_extendedprice', 'unit_price').replace('l_discount', 'discount_pct')} AS DOUBLE) AS net_amount,
         concat_ws(',', CASE WHEN u.user_id IS NULL THEN 'unknown_user_id' END, CASE WHEN p.product_id IS NULL THEN 'unknown_product_id' END) AS reasons
  FROM lines e LEFT JOIN known_users u ON e.user_id = u.user_id LEFT JOIN known_later p ON e.product_id = p.product_id
  WHERE quantity > 0 AND unit_price > 0)
SELECT * FROM judged""")
def silver_orders_second_batch(spark, d):
    """Order lines of two batches: the second replaces lines, adds others, and by then more products are known."""
    path, keys = scratch_path(spark, "silver-orders"), ["order_id", "line_no"]
    raw = lines_of(table(spark, d, "lineitem"), table(spark, d, "orders"), *sort_names(LINE_ORDER + LINE_TIEBREAK))
    known_users, known_products = _known(spark, d)
    known_later = table(spark, d, "part").filter("p_size <= 40").select(F.col("p_partkey").alias("product_id"))
    later = raw.where("line_no IN (3, 4)").withColumn("quantity", F.when(F.col("line_no") == 3, F.col("quantity") + 1).otherwise(F.col("quantity")))
    for batch, rows, things in (("b1", raw.where("line_no <= 3"), known_products), ("b2", later, known_later)):
        tagged = silver.orders(rows, known_users, things, keys=keys, order=LINE_ORDER, tiebreak=LINE_TIEBREAK)
        increments.apply_batch(spark, path, tagged, keys, F.trunc("order_timestamp", "month"), batch,
                               lambda stored, things=things: silver.tag_known(stored, known_users, things))
    stored = spark.read.parquet(path).where("quantity > 0 AND unit_price > 0")
    return stored.select("order_id", "line_no", "user_id", "product_id", "order_timestamp", "quantity", "unit_price", "net_amount",
                         F.col(increments.BATCH).alias("batch"), F.array_join(quality.REASONS, ",").alias("reasons"))
