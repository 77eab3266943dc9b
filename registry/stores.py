"""Versioned tables and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from registry import register
from registry.star import table
from tradeloom.session import scratch_path
from tradeloom.sources.versioned import VersionedTable
from tradeloom.streaming import messages as feeds
from tradeloom.streaming import orders as live

# Version 0 holds the customers; version 1 settles negative balances and adds the suppliers.
V0 = "v0 AS (SELECT c_custkey AS id, c_name AS name, c_acctbal AS balance FROM customer)"
V1 = """v1 AS (SELECT c_custkey AS id, c_name AS name, 0.0::DOUBLE AS balance FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT -1 - s_suppkey, s_name, s_acctbal FROM supplier)"""


def _accounts(spark, d) -> VersionedTable:
    accounts = VersionedTable(spark, scratch_path(spark, "accounts"), ["id"])
    customers = table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                                   F.col("c_acctbal").alias("balance"))
    suppliers = table(spark, d, "supplier").select((F.lit(-1) - F.col("s_suppkey")).alias("id"),
                                                   F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    settled = customers.filter("balance < 0").withColumn("balance", F.lit(0.0))
    accounts.upsert(customers, ["name"], ["balance"])
    accounts.upsert(settled.unionByName(suppliers), ["name"], ["balance"])
    return accounts


@register(f"""WITH {V0}, {V1} SELECT id, name, balance FROM v1
UNION ALL SELECT id, name, balance FROM v0 ANTI JOIN v1 USING (id)""")
def versioned_read_current(spark, d):
    return _accounts(spark, d).read()


@register(f"WITH {V0} SELECT id, name, balance FROM v0")
def versioned_read_as_of(spark, d):
    return _accounts(spark, d).read_as_of(0)


@register(f"""WITH {V0}, {V1} SELECT 0::BIGINT AS version, 'upsert' AS operation, count(*) AS rows_inserted, 0::BIGINT AS rows_updated,
  0::BIGINT AS rows_deleted FROM v0
UNION ALL SELECT 1, 'upsert', count(*) FILTER (id < 0), count(*) FILTER (id >= 0), 0 FROM v1
UNION ALL SELECT 2, 'rollback to 0', 0, count(*) FILTER (id >= 0), count(*) FILTER (id < 0) FROM v1""")
def version_history(spark, d):
    accounts = _accounts(spark, d)
    accounts.rollback(0)
    return accounts.history().drop("committed_at")


@register(f"WITH {V0} SELECT id, name, balance FROM v0")
def version_rollback(spark, d):
    accounts = _accounts(spark, d)
    accounts.rollback(0)
    return accounts.read()


@register(f"""WITH {V0}, {V1} SELECT id, name, balance FROM v1
UNION ALL SELECT id, name, balance FROM v0 ANTI JOIN v1 USING (id)""")
def version_compact(spark, d):
    accounts = _accounts(spark, d)
    accounts.compact(1)
    return accounts.read()


# Events as live orders: one message each, those of type signup unreadable.
MESSAGES = """live AS (
  SELECT CAST(event_id AS VARCHAR) AS order_id, CAST(user_id AS VARCHAR) AS user_id, CAST(event_id % 7 AS VARCHAR) AS product_id,
         CAST(1 + event_id % 3 AS INTEGER) AS quantity, CAST(value AS DECIMAL(18,2)) AS unit_price,
         event_type AS payment_method, CASE event_type WHEN 'error' THEN 'failed' ELSE 'success' END AS payment_status,
         date_trunc('second', ts) AS order_timestamp, ts AS kafka_ingest_ts,
         CAST((1 + event_id % 3) * CAST(value AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS net_amount
  FROM events WHERE event_type <> 'signup')"""
LIVE_COLUMNS = """order_id, user_id, product_id, quantity, CAST(unit_price AS DOUBLE) AS unit_price, payment_method,
  payment_status, order_timestamp, kafka_ingest_ts, CAST(net_amount AS DOUBLE) AS net_amount"""


def to_messages(events: DataFrame, status: str = "success") -> DataFrame:
    order = F.to_json(F.struct(
        F.col("event_id").cast("string").alias("order_id"), F.col("user_id").cast("string").alias("user_id"),
        (F.col("event_id") % 7).cast("string").alias("product_id"), (F.col("event_id") % 3 + 1).alias("quantity"),
        F.col("value").alias("unit_price"), F.col("event_type").alias("payment_method"),
        F.when(F.col("event_type") == "error", F.lit("failed")).otherwise(F.lit(status)).alias("payment_status"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("order_timestamp")))
    text = F.when(F.col("event_type") == "signup", F.lit("{bad")).otherwise(order)
    return events.select(F.col("user_id").cast("string").cast("binary").alias("key"),
                         text.cast("binary").alias("value"), F.col("ts").alias("timestamp"))


def message_stream(spark, d) -> DataFrame:
    """The events table as a stream of messages."""
    schema = spark.read.parquet(f"{d}/events.parquet").schema
    # as a glob, the table may be one file or a folder of files
    events = spark.readStream.schema(schema).parquet(f"{d}/events.parque[t]")
    return to_messages(events.withColumn("ts", F.col("ts").cast("timestamp")))


def _to_files(spark, stream: DataFrame, label: str) -> DataFrame:
    path = scratch_path(spark, label)
    query = (stream.writeStream.outputMode("append").format("parquet").option("path", path)
             .option("checkpointLocation", f"{path}-checkpoint").trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


@register(f"""WITH {MESSAGES} SELECT {LIVE_COLUMNS}, true AS usable FROM live
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, ts, NULL, false FROM events WHERE event_type = 'signup'""")
def stream_decode(spark, d):
    decoded = live.decode_orders(message_stream(spark, d)).withColumn("usable", F.col("order_id").isNotNull())
    return _to_files(spark, decoded.drop("raw_value"), "decoded")


WINDOWS = MESSAGES + """, windows AS (
  SELECT time_bucket(INTERVAL '{size}', kafka_ingest_ts) AS window_start,
         time_bucket(INTERVAL '{size}', kafka_ingest_ts) + INTERVAL '{size}' AS window_end,
         count(*) AS orders_in_window, CAST(sum(net_amount) AS DOUBLE) AS revenue_in_window,
         round(avg(CASE WHEN payment_status = 'failed' THEN 1.0 ELSE 0.0 END), 3) AS failure_rate
  FROM live GROUP BY 1, 2)"""


def _windows(spark, d, mode: str, size: str) -> DataFrame:
    """The windowed metrics of the whole stream, as the sink's files hold them at its end."""
    path = scratch_path(spark, "windows")
    orders = live.well_formed(live.decode_orders(message_stream(spark, d)))
    live.start_metrics(orders, f"{path}-checkpoint", mode, path, available_now=True, window=size).awaitTermination()
    stored = spark.read.schema(live.window_metrics(orders).schema).parquet(path)
    return stored.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
                         "orders_in_window", "revenue_in_window", "failure_rate")


@register(f"WITH {WINDOWS.format(size='30 seconds')} SELECT * FROM windows")
def stream_window_complete(spark, d):
    return _windows(spark, d, "complete", "30 seconds")


@register(f"""WITH {WINDOWS.format(size='1 hour')} SELECT * FROM windows
WHERE window_end <= (SELECT max(kafka_ingest_ts) FROM live) - INTERVAL '1 minute'""")
def stream_window_append(spark, d):
    return _windows(spark, d, "append", "1 hour")


@register(f"""WITH {MESSAGES} SELECT {LIVE_COLUMNS.replace('payment_status', "CASE payment_status WHEN 'failed' THEN 'failed' ELSE 'settled' END AS payment_status").replace('kafka_ingest_ts', 'kafka_ingest_ts + INTERVAL 1 DAY AS kafka_ingest_ts')}
FROM live""")
def stream_upsert_landing(spark, d):
    """Every order arrives, arrives again a day later settled, and is replayed after a restart."""
    feed, store = scratch_path(spark, "feed"), scratch_path(spark, "landing")
    events = table(spark, d, "events")
    day_later = to_messages(events, "settled").withColumn("timestamp", F.col("timestamp") + F.expr("INTERVAL 1 DAY"))
    to_messages(events).unionByName(day_later).write.parquet(feed)
    for replay in (None, day_later):
        if replay is not None:
            replay.write.mode("append").parquet(feed)
        live.start_landing(feeds.file_messages(spark, feed), store, f"{store}-checkpoint",
                           available_now=True).awaitTermination()
    return live.landed(spark, store)


def _run_parts(spark, feed: str, parts: list[DataFrame], start) -> None:
    """Start the stream anew after each part; it goes on from its checkpoint."""
    for part in parts:
        part.write.mode("append").parquet(feed)
        for query in start():
            query.awaitTermination()


def _halves(spark, d) -> list[DataFrame]:
    """Messages up to the middle of the time, and all later ones with a tenth of the earlier ones, which come late."""
    events = table(spark, d, "events")
    middle = events.agg(F.expr("timestamp_micros((unix_micros(min(ts)) + unix_micros(max(ts))) div 2)")).scalar()
    early = (F.col("ts") < middle) & (F.col("event_id") % 10 != 0)
    return [to_messages(events.where(early)), to_messages(events.where(~early))]


@register(f"""WITH {MESSAGES},
middle AS (SELECT make_timestamp((epoch_us(min(ts)) + epoch_us(max(ts))) // 2) AS at FROM events),
early AS (SELECT max(kafka_ingest_ts) - INTERVAL '1 minute' AS watermark FROM live, middle
          WHERE kafka_ingest_ts < middle.at AND CAST(order_id AS BIGINT) % 10 <> 0),
windowed AS (
  SELECT *, time_bucket(INTERVAL '1 hour', kafka_ingest_ts) AS window_start, time_bucket(INTERVAL '1 hour', kafka_ingest_ts) + INTERVAL '1 hour' AS window_end
  FROM live),
in_time AS (
  SELECT windowed.* FROM windowed, middle, early
  WHERE (kafka_ingest_ts < middle.at AND CAST(order_id AS BIGINT) % 10 <> 0) OR window_end > early.watermark)
SELECT window_start, window_end, count(*) AS orders_in_window, CAST(sum(net_amount) AS DOUBLE) AS revenue_in_window
FROM in_time GROUP BY 1, 2 HAVING window_end <= (SELECT max(kafka_ingest_ts) FROM live) - INTERVAL '1 minute'""")
def stream_late_rows(spark, d):
    """Windows of a stream whose second half brings rows that are too late; the watermark moved when the first half had ended."""
    feed, path = scratch_path(spark, "late-feed"), scratch_path(spark, "late-windows")
    orders = lambda: live.well_formed(live.decode_orders(feeds.file_messages(spark, feed)))
    _run_parts(spark, feed, _halves(spark, d), lambda: [live.start_metrics(orders(), f"{path}-checkpoint", "append", path, True, window="1 hour")])
    stored = spark.read.schema(live.window_metrics(orders()).schema).parquet(path)
    return stored.select(F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "orders_in_window", "revenue_in_window")


@register(f"""WITH {WINDOWS.format(size='1 hour')}
SELECT 'landed' AS sink, order_id AS id, 1 AS orders, CAST(net_amount AS DOUBLE) AS amount FROM live
UNION ALL SELECT 'windows', strftime(window_start, '%Y-%m-%d %H:%M:%S'), orders_in_window, revenue_in_window FROM windows
UNION ALL SELECT 'quarantined', strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 1, NULL FROM events WHERE event_type = 'signup'""")
def stream_two_queries(spark, d):
    """Landing and windows from one feed side by side, each with its own checkpoint, stopped and started again."""
    feed, store = scratch_path(spark, "shared-feed"), scratch_path(spark, "two-sinks")
    messages = lambda: feeds.file_messages(spark, feed)
    _run_parts(spark, feed, _halves(spark, d), lambda: live.start_live(
        messages(), store, f"{store}-checkpoints", True, f"{store}/windows", mode="complete", window="1 hour"))
    windows = spark.read.schema(live.window_metrics(live.well_formed(live.decode_orders(messages()))).schema).parquet(f"{store}/windows")
    return (live.landed(spark, store).select(F.lit("landed").alias("sink"), F.col("order_id").alias("id"), F.lit(1).cast("long").alias("orders"),
                                             F.col("net_amount").cast("double").alias("amount"))
            .unionByName(windows.select(F.lit("windows").alias("sink"), F.date_format("window.start", "yyyy-MM-dd HH:mm:ss").alias("id"),
                                        F.col("orders_in_window").alias("orders"), F.col("revenue_in_window").cast("double").alias("amount")))
            .unionByName(live.quarantined(spark, store).select(
                F.lit("quarantined").alias("sink"), F.date_format("kafka_ingest_ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("id"),
                F.lit(1).cast("long").alias("orders"), F.lit(None).cast("double").alias("amount"))))
