"""What a task holds while it lands and splits files."""

import json
import subprocess
import sys
from pathlib import Path

from pyspark.sql import functions as F

from tradeloom.operators import quality
from tradeloom.session import SPLIT, SPLIT_BYTES, build_session, tune
from tradeloom.sources import files


def land(folder):
    """Two batches and a split in a session of their own, whose event log tells the plans."""
    spark = build_session("landing", "local[2]", 2, {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false", "spark.eventLog.dir": f"file://{folder}/events"})
    spark.range(100).selectExpr("cast(id as string) AS id").write.option("header", True).csv(f"{folder}/raw")
    rows = spark.read.option("header", True).csv(f"{folder}/raw")
    for batch in ("b1", "a b:2", "b1"):
        assert files.ingest(rows, f"{folder}/bronze", batch) == 100
    quality.land_split(quality.tag_rows(spark.range(100), {"even": F.col("id") % 2 == 0}), f"{folder}/sides")
    spark.stop()


def test_landing_and_splitting_sort_nothing(spark, folder, rows):
    (Path(folder) / "events").mkdir()
    root = Path(__file__).resolve().parent.parent
    subprocess.run([sys.executable, "-c", f"import sys; sys.path[:0] = [{str(root)!r}, {str(root / 'tests')!r}]\n"
                    f"import test_task_memory; test_task_memory.land({folder!r})"], check=True, timeout=300)
    plans = [e["physicalPlanDescription"] for log in (Path(folder) / "events").iterdir() for e in map(json.loads, log.open())
             if e["Event"].endswith("SparkListenerSQLExecutionStart")]
    writes = [plan for plan in plans if "bronze" in plan or "sides" in plan]
    assert len([plan for plan in writes if "InsertIntoHadoopFsRelationCommand" in plan]) >= 4
    assert not [plan for plan in writes if "Sort" in plan]
    landed = spark.read.parquet(f"{folder}/bronze").groupBy("_batch_id").count()
    assert rows(landed) == [("a b:2", 100), ("b1", 100)]
    good, bad = quality.read_split(spark, f"{folder}/sides")
    assert rows(good) == [(i,) for i in range(0, 100, 2)]
    assert rows(bad, "id") == [(i,) for i in range(1, 100, 2)]


def test_many_folders_are_written_whole(spark, folder, rows):
    many = spark.range(0, 600, 1, 3).withColumn("part", F.concat(F.lit("p"), F.col("id") % 7))
    files.write_results(many, f"{folder}/many", partition_by=["part"])
    assert rows(spark.read.parquet(f"{folder}/many"), "id", "part") == rows(many)


def test_a_task_reads_a_bounded_part_of_a_file(spark, folder):
    with open(f"{folder}/lines", "w") as out:
        out.writelines("x" * 1023 + "\n" for _ in range(SPLIT_BYTES // 1024 * 3 // 2))
    before = spark.conf.get(SPLIT)
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        for given, kept in (("128m", str(SPLIT_BYTES)), ("1g", str(SPLIT_BYTES)), ("134217728b", str(SPLIT_BYTES)), ("4MB", "4MB")):
            spark.conf.set(SPLIT, given)
            assert tune(spark).conf.get(SPLIT) == kept
        spark.conf.set(SPLIT, "128m")
        assert tune(spark).read.text(f"{folder}/lines").rdd.getNumPartitions() > 1
    finally:
        spark.conf.set(SPLIT, before)
        spark.conf.unset("spark.sql.files.minPartitionNum")
