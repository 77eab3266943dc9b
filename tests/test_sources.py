import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradeloom import schemas
from tradeloom.operators.layout import plan_text
from tradeloom.session import SQL_SETTINGS, scratch_path, scratch_root, written
from tradeloom.sources import files, rows as literal


def test_session_settings(spark):
    for key, value in SQL_SETTINGS.items():
        assert spark.conf.get(key) == value


def test_scratch_is_the_shared_folder_of_the_session(spark):
    assert scratch_root(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_written_cuts_the_lineage(spark, rows):
    df = written(spark.range(5).withColumn("x", F.col("id") * 2))
    assert "Range" not in plan_text(df) and rows(df, "x") == [(0,), (2,), (4,), (6,), (8,)]


def test_csv_with_schema_keeps_corrupt_lines(spark, folder):
    spark.createDataFrame([("id,salary",), ("1,10",), ("x,20",)], "value string").coalesce(1).write.text(f"{folder}/c")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("salary", T.IntegerType())])
    got = {(r.id, r.salary, r[files.CORRUPT]) for r in files.read_csv(spark, f"{folder}/c", schema).collect()}
    assert got == {(1, 10, None), (None, 20, "x,20")}
    inferred = files.read_csv(spark, f"{folder}/c")
    assert dict(inferred.dtypes) == {"id": "string", "salary": "int"}


@pytest.mark.parametrize("fmt", files.FORMATS)
def test_round_trips(spark, rows, fmt):
    df = spark.createDataFrame([(1, "a", 1.5), (2, None, None)], "id int, s string, x double")
    df = df.withColumn("t", F.lit("2024-01-01 10:00:00.123456").cast("timestamp"))
    assert rows(files.round_trip(df, fmt)) == rows(df)


def test_unknown_format_raises(spark, folder):
    with pytest.raises(ValueError):
        files.write_results(spark.range(1), f"{folder}/x", "xlsx")


def test_write_modes(spark, folder):
    path = f"{folder}/t"
    for mode, expected in (("overwrite", 3), ("append", 6), ("ignore", 6), ("overwrite", 3)):
        files.write_results(spark.range(3), path, mode=mode)
        assert spark.read.parquet(path).count() == expected
    with pytest.raises(AnalysisException):
        files.write_results(spark.range(3), path, mode="error")


def test_partition_filter_prunes_and_value_filter_is_pushed(spark, folder):
    df = spark.range(100).select("id", (F.col("id") % 4).cast("string").alias("day"), F.lit("x").alias("unused"))
    files.write_results(df, f"{folder}/t", partition_by=["day"])
    plan = plan_text(files.read_parquet(spark, f"{folder}/t").filter("day = '3' AND id > 50").select("id"))
    scan = plan[plan.index("PartitionFilters"):]
    assert "(day" in scan.splitlines()[0] and "GreaterThan(id,50)" in scan
    assert "unused" not in scan


def test_bronze_appends_batches_and_replaces_a_repeated_one(spark, folder):
    files.write_results(spark.range(3), f"{folder}/raw")
    raw = files.read_parquet(spark, f"{folder}/raw")
    assert [files.ingest(raw, f"{folder}/bronze", b) for b in ("b1", "b2", "b1")] == [3, 3, 3]
    bronze = files.read_parquet(spark, f"{folder}/bronze")
    assert bronze.count() == 6
    assert bronze.filter("_source_file LIKE '%.parquet' AND _ingested_at IS NOT NULL").count() == 6


def test_export_is_one_csv_only_if_asked_for(spark, folder):
    df = spark.range(0, 100, 1, 4)
    assert files.export_for_bi(df, folder, "small", single_file=True) == 100
    assert files.export_for_bi(df, folder, "large") == 100
    counts = {name: len({r[0] for r in spark.read.option("header", True).csv(f"{folder}/{name}_csv")
                        .select(F.col("_metadata.file_path")).collect()}) for name in ("small", "large")}
    assert counts["small"] == 1 and counts["large"] >= 2
    assert spark.read.parquet(f"{folder}/large_parquet").count() == 100


def test_literal_rows_and_sequence(spark, rows):
    users = literal.from_rows(spark, [("u1",) + (None,) * 6], schemas.USERS_RAW)
    assert users.schema == schemas.USERS_RAW
    assert rows(literal.sequence(spark, 2, 5, "n")) == [(2,), (3,), (4,)]


def test_text_lines(spark, folder, rows):
    spark.createDataFrame([("a b",), ("c",)], "value string").write.text(f"{folder}/t")
    assert rows(files.read_lines(spark, f"{folder}/t")) == [("a b",), ("c",)]


def test_clear_scratch_leaves_nothing_behind(spark):
    from tradeloom.session import clear_scratch, scratch_folder
    from tradeloom.sources import paths
    written(spark.range(3))
    assert paths.exists(spark, scratch_folder(spark))
    clear_scratch(spark)
    assert not paths.exists(spark, scratch_folder(spark))


def test_json_lines_that_cannot_be_read_are_kept_whole(spark, folder):
    lines = ['{"id": 1, "name": "a"}', *(f"broken {i}" for i in range(50))]
    spark.createDataFrame([(line,) for line in lines], "value string").write.text(f"{folder}/j")
    got = files.read_json(spark, f"{folder}/j", T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())]))
    assert {r[files.CORRUPT] for r in got.collect()} == {None, *lines[1:]}
