"""Message streams with the columns ``key``, ``value`` (binary) and ``timestamp``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.schemas import ENVELOPE


def kafka_messages(spark: SparkSession, servers: str, topic: str, starting: str = "latest") -> DataFrame:
    """A Kafka topic; needs the Kafka connector package on the session."""
    return (spark.readStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("subscribe", topic)
            .option("startingOffsets", starting)
            .load().select(*ENVELOPE.fieldNames()))


def file_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Parquet files of messages, for replays and for sources that drop files."""
    return _file_stream(spark, files_per_batch).schema(ENVELOPE).parquet(path)


def line_messages(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Text files with one JSON message per line; a message arrives when its file was written."""
    lines = _file_stream(spark, files_per_batch).text(path)
    return lines.select(F.lit(None).cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                        F.col("_metadata.file_modification_time").alias("timestamp"))


def _file_stream(spark: SparkSession, files_per_batch: int | None):
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else reader
