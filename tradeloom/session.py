"""Session settings, the shared scratch folder, and tables written to cut lineage."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tradeloom.sources import paths

# SQL settings that results or skew handling depend on. They can be changed at run time,
# so they are also applied to a session somebody else built.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join even if a later step then needs one more shuffle
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # rows of up to two folders (a batch, the two sides of a split) go straight to their files, where all rows of a task
    # would be sorted by folder first; beyond two folders Spark sorts the rest
    "spark.sql.maxConcurrentOutputFileWriters": "2",
}
# most bytes of files that one task reads: columnar files hold 20 times their size in rows, and a task that keeps
# one row per key sorts all of them
SPLIT, SPLIT_BYTES = "spark.sql.files.maxPartitionBytes", 32 * 1024 * 1024
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_UNITS = {"": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


_steps: ContextVar[str | None] = ContextVar("steps", default=None)  # folder of the tables that go when a step is done


def build_session(app_name: str, master: str | None = None, shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session with the library's settings.

    ``shuffle_partitions`` is an upper bound that AQE coalesces; on a cluster give it
    2-3 times the executor cores, and more where a stage shuffles many TB (aim at
    100-200 MB per reduce task).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in {**SQL_SETTINGS, **(extra or {})}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def tune(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to an existing session; smaller splits than ours stay."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    number, unit = re.fullmatch(r"(\d+)\s*([kmgt]?)b?", spark.conf.get(SPLIT).strip().lower()).groups()
    if int(number) * _UNITS[unit] > SPLIT_BYTES:
        spark.conf.set(SPLIT, str(SPLIT_BYTES))
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: the checkpoint folder of the session.

    A machine-local temporary folder is used only when the session names none and runs in
    local mode, where there is only one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tradeloom-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder."""
    return f"{scratch_root(spark)}/tradeloom/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove this application's intermediate tables; results that still read them break."""
    paths.remove(spark, scratch_folder(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path for an intermediate table."""
    return f"{_steps.get() or scratch_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    Cuts the lineage with files that outlive any executor; later passes read only the
    columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of a write inside go when it is done, where they would stay until the driver collects garbage."""
    before = spark.conf.get(SHUFFLES_GO, "false")
    spark.conf.set(SHUFFLES_GO, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLES_GO, before)


@contextmanager
def passing_tables(spark: SparkSession, label: str = "steps") -> Iterator[None]:
    """Intermediate tables that are written inside are removed at the end, and no others of the application."""
    folder = scratch_path(spark, label)
    outer = _steps.set(folder)
    try:
        yield
    finally:
        _steps.reset(outer)
        paths.remove(spark, folder)


def written_alone(spark: SparkSession, make: Callable[[], DataFrame], label: str = "cut") -> DataFrame:
    """Write what ``make()`` returns and return the written table; the tables that ``make`` wrote on its way are removed.

    For steps that need many or large tables to find a smaller result.
    """
    path = scratch_path(spark, label)
    with passing_tables(spark, f"{label}-steps"):
        result = make()
        result.write.parquet(path)
    return spark.read.schema(result.schema).parquet(path)
