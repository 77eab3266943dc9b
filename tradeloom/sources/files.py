"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameReader, Observation, SparkSession, functions as F
from pyspark.sql import types as T

from tradeloom.session import scratch_path

CORRUPT = "_corrupt_record"
FORMATS = ("csv", "json", "parquet")
# the default of the text formats drops the microseconds
_TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the files twice to infer one.

    With a schema, a line that doesn't fit is kept whole in ``_corrupt_record``.
    """
    if schema is None:
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return _tolerant(spark, schema).option("header", True).csv(path)


def _tolerant(spark: SparkSession, schema: T.StructType) -> DataFrameReader:
    return (spark.read.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
            .schema(T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])))


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """JSON lines. With a schema, a line that can't be read is kept whole in ``_corrupt_record``."""
    return (_tolerant(spark, schema) if schema else spark.read).json(path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


def with_utc_timestamps(df: DataFrame) -> DataFrame:
    """Zone-less timestamps as instants (the session runs in UTC); streams need instants."""
    zoneless = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({name: F.col(name).cast("timestamp") for name in zoneless})


def write_results(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None, max_records_per_file: int | None = None) -> None:
    if fmt not in FORMATS:
        raise ValueError(f"format {fmt!r} is not one of {', '.join(FORMATS)}")
    writer = df.write.format(fmt).mode(mode)
    if fmt != "parquet":
        writer = writer.options(**_TEXT_TIMES)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    writer.save(path)


def with_provenance(df: DataFrame) -> DataFrame:
    """Adds when a row was read and from which file."""
    return df.select("*", F.current_timestamp().alias("_ingested_at"),
                     F.col("_metadata.file_path").alias("_source_file"))


def ingest(df: DataFrame, path: str, batch_id: str) -> int:
    """Append one batch with provenance columns and return its row count.

    Each batch has its own ``_batch_id`` folder, which a repeated run replaces, so the
    table is an append-only history of what landed. Rows are counted by the writing job.
    """
    seen = Observation()
    (with_provenance(df).withColumn("_batch_id", F.lit(batch_id))
     .observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd")
     .partitionBy("_batch_id").parquet(path))
    return seen.get["rows"]


def export_for_bi(df: DataFrame, root: str, name: str, single_file: bool = False, rows_per_file: int = 1_000_000) -> int:
    """Parquet and CSV copies of a table for BI tools; returns the row count.

    The caller decides whether the CSV is one file, which one task writes; the layout never depends on the row count.
    """
    spark = df.sparkSession
    seen = Observation()
    (df.observe(seen, F.count(F.lit(1)).alias("rows"))
     .write.mode("overwrite").parquet(f"{root}/{name}_parquet"))
    rows = seen.get["rows"]
    exported = spark.read.schema(df.schema).parquet(f"{root}/{name}_parquet")
    if single_file:
        write_results(exported.coalesce(1), f"{root}/{name}_csv", "csv")
    else:
        write_results(exported, f"{root}/{name}_csv", "csv", max_records_per_file=rows_per_file)
    return rows


def round_trip(df: DataFrame, fmt: str) -> DataFrame:
    """Write a table to the shared folder in a format and read it back, typed as before."""
    spark = df.sparkSession
    path = scratch_path(spark, f"trip-{fmt}")
    write_results(df, path, fmt)
    reader = spark.read.schema(df.schema)
    return reader.option("header", True).csv(path) if fmt == "csv" else reader.format(fmt).load(path)
