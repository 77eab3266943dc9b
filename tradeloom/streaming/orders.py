"""Live orders: decoding, landing without duplicates, windowed metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tradeloom.functions.columns import as_money, as_timestamp, rate
from tradeloom.schemas import ENVELOPE, LIVE_ORDER, MONEY
from tradeloom.operators.dedup import dedup_latest

# Fixed values of the live feed.
WINDOW = "30 seconds"
WATERMARK = "1 minute"

_REQUIRED = ("order_id", "quantity", "unit_price", "net_amount")
# the last message of an order wins; equal arrival times are settled by batch, then by content
LATEST = ["kafka_ingest_ts desc", "batch desc"]
TIEBREAK = ["order_timestamp desc", "user_id", "product_id", "quantity", "unit_price",
            "payment_method", "payment_status"]


def decode_orders(messages: DataFrame) -> DataFrame:
    """Typed order columns, arrival time, amount and the raw text; the same for batch and stream.

    The live feed knows no discount, so ``net_amount`` is quantity times price.
    """
    return (messages
            .select(F.col("value").cast("string").alias("raw_value"),
                    F.col("timestamp").alias("kafka_ingest_ts"))
            .withColumn("data", F.from_json("raw_value", LIVE_ORDER))
            .select("data.*", "kafka_ingest_ts", "raw_value")
            .withColumns({"order_timestamp": as_timestamp("order_timestamp"),
                          "unit_price": as_money("unit_price")})
            .withColumn("net_amount", F.round(F.col("quantity").cast("decimal(10,0)")
                                              * F.col("unit_price"), 2).try_cast(MONEY)))


def _complete():
    condition = F.lit(True)
    for c in _REQUIRED:
        condition = condition & F.col(c).isNotNull()
    return condition


def well_formed(decoded: DataFrame) -> DataFrame:
    return decoded.filter(_complete()).drop("raw_value")


def malformed(decoded: DataFrame) -> DataFrame:
    """Messages that are not a usable order, as they came."""
    return decoded.filter(~_complete()).select("kafka_ingest_ts", "raw_value")


def window_metrics(orders: DataFrame, window: str = WINDOW, watermark: str = WATERMARK) -> DataFrame:
    """Orders, revenue and payment failure rate per tumbling window of the arrival time.

    Revenue includes failed payments. In append or update mode rows later than the watermark
    are dropped and the state stays small; complete mode keeps every window and drops nothing.
    """
    return (orders.withWatermark("kafka_ingest_ts", watermark)
            .groupBy(F.window("kafka_ingest_ts", window))
            .agg(F.count(F.lit(1)).alias("orders_in_window"),
                 F.round(F.sum("net_amount"), 2).alias("revenue_in_window"),
                 F.round(rate(F.col("payment_status") == "failed"), 3).alias("failure_rate")))


def start_metrics(orders: DataFrame, checkpoint: str, mode: str = "complete", path: str | None = None,
                  available_now: bool = False, **window) -> StreamingQuery:
    """Run the windowed metrics to the console, or into Parquet files below ``path``.

    Complete mode sorts by window and replaces the files with every batch; append mode adds
    the windows the watermark has closed. Update mode is for the console.
    """
    metrics = window_metrics(orders, **window)
    if mode == "complete":
        metrics = metrics.orderBy("window")
    writer = metrics.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if path is None:
        writer = writer.format("console").option("truncate", False)
    elif mode == "complete":
        writer = writer.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(path))
    else:
        writer = writer.format("parquet").option("path", path)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def _land(path: str):
    def land(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "none"
        (decode_orders(batch).withColumn("usable", _complete())
         .write.mode("overwrite").partitionBy("usable").parquet(f"{path}/messages/query={query}/batch={batch_id}"))
    return land


def _landed_messages(spark: SparkSession, path: str, usable: bool) -> DataFrame:
    empty = spark.createDataFrame([], ENVELOPE)
    layout = "query string, batch long, usable boolean"
    schema = T.StructType([*decode_orders(empty).schema.fields, *T.StructType.fromDDL(layout).fields])
    return spark.read.schema(schema).parquet(f"{path}/messages").where(F.col("usable") == usable).drop("usable")


def landed(spark: SparkSession, path: str, up_to_batch: int | None = None) -> DataFrame:
    """One row per order: its last message, of all batches or of those up to one. Landing a batch costs what the batch costs;
    copies are settled here, by one window over the orders."""
    usable = _landed_messages(spark, path, True)
    if up_to_batch is not None:
        usable = usable.where(F.col("batch") <= up_to_batch)
    return dedup_latest(usable, ["order_id"], LATEST, [*TIEBREAK, "query"]).drop("raw_value", "query", "batch")


def quarantined(spark: SparkSession, path: str) -> DataFrame:
    """Messages that are no usable order, as they came."""
    return _landed_messages(spark, path, False).select("kafka_ingest_ts", "raw_value", "batch")


def start_landing(messages: DataFrame, path: str, checkpoint: str,
                  available_now: bool = False) -> StreamingQuery:
    """Land each micro-batch in a folder of its own, usable and other messages apart; a replayed batch replaces its folder.

    A stream with a fresh checkpoint lands beside the folders of the one before.
    """
    writer = (messages.writeStream.foreachBatch(_land(path)).outputMode("update")
              .option("checkpointLocation", checkpoint))
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_live(messages: DataFrame, path: str, checkpoints: str, available_now: bool = False,
               metrics_path: str | None = None, **metrics) -> list[StreamingQuery]:
    """Landing and metrics side by side, each with its own checkpoint; metrics go to the console unless a path is given."""
    return [start_landing(messages, path, f"{checkpoints}/landing", available_now),
            start_metrics(well_formed(decode_orders(messages)), f"{checkpoints}/metrics", path=metrics_path,
                          available_now=available_now, **metrics)]


def run_live(messages: DataFrame, path: str, checkpoints: str) -> None:
    """Run both until one stops."""
    start_live(messages, path, checkpoints)
    messages.sparkSession.streams.awaitAnyTermination()
