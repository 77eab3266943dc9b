import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import Window, functions as F

from tradeloom.operators import aggregates, joins, layout, quality, ranking, skew
from tradeloom.operators.dedup import dedup_latest
from tradeloom.operators.ordering import sort_columns
from tradeloom.session import written


# --- dedup --------------------------------------------------------------------------------

DUPLICATES = [(1, "a", 1), (1, "b", 2), (1, "c", 2), (2, "d", 1)]


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_dedup_is_the_same_for_any_partitioning(spark, rows, parts):
    df = spark.createDataFrame(DUPLICATES, "k int, v string, t int").repartition(parts)
    assert rows(dedup_latest(df, ["k"], ["t desc"], ["v"]), "k", "v") == [(1, "b"), (2, "d")]


def test_dedup_wants_a_total_order(spark):
    df = spark.createDataFrame(DUPLICATES, "k int, v string, t int")
    with pytest.raises(ValueError):
        dedup_latest(df, ["k"], ["t desc"], [])
    with pytest.raises(ValueError):
        sort_columns(["t downwards"])


def test_dedup_keeps_one_row_per_key_and_task_before_the_shuffle(spark):
    df = spark.createDataFrame(DUPLICATES, "k int, v string, t int")
    plan = layout.plan_text(dedup_latest(df, ["k"], ["t desc"], ["v"]), "simple")
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


# --- quality ------------------------------------------------------------------------------

def test_split_keeps_every_row_and_names_the_broken_rules(spark, rows):
    df = spark.createDataFrame([("1", 2), (None, 1), ("3", 0), (None, None)], "id string, qty int")
    good, bad = quality.split(df, {"id": F.col("id").isNotNull(), "qty": F.col("qty") > 0})
    assert rows(good) == [("1", 2)]
    assert {(r.id, r.qty, tuple(r[quality.REASONS])) for r in bad.collect()} == {
        (None, 1, ("id",)), ("3", 0, ("qty",)), (None, None, ("id", "qty"))}


def test_integrity_and_orphans_share_the_rows(spark, rows):
    facts = spark.createDataFrame([(1, 10), (2, 20), (3, None), (4, 10)], "f int, user_id int")
    users = spark.createDataFrame([(10,), (30,)], "user_id int")
    assert rows(quality.keep_known(facts, users, "user_id"), "f") == [(1,), (4,)]
    assert rows(quality.orphans(facts, users, "user_id"), "f") == [(2,), (3,)]
    tagged = quality.tag_unknown(facts, users.union(users), "user_id")
    assert tagged.count() == 4
    assert rows(quality.accepted(tagged), "f") == [(1,), (4,)]


def test_land_split_writes_both_sides_once(spark, rows, folder):
    df = spark.createDataFrame([(1,), (-1,), (2,)], "x int")
    good, bad = quality.land_split(quality.tag_rows(df, {"positive": F.col("x") > 0}), f"{folder}/t")
    assert rows(good) == [(1,), (2,)] and good.columns == ["x"]
    assert [(r.x, r[quality.REASONS]) for r in bad.collect()] == [(-1, ["positive"])]


# --- joins --------------------------------------------------------------------------------

def _sides(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (2, "c"), (None, "d")], "k int, l string")
    right = spark.createDataFrame([(2, "x"), (3, "y"), (None, "z")], "k int, r string")
    return left, right


@pytest.mark.parametrize("how, n", [("inner", 2), ("left", 4), ("right", 4), ("full", 6), ("left_semi", 2), ("left_anti", 2)])
@pytest.mark.parametrize("hot", [None, [2]])
def test_salted_join_equals_the_plain_join(spark, rows, how, n, hot):
    left, right = _sides(spark)
    keys = None if hot is None else spark.createDataFrame([(k,) for k in hot], "k int")
    got = skew.salted_join(left, right, ["k"], how, hot=keys, min_share=0.3)
    wanted = left.join(right, "k", how)
    assert got.columns == wanted.columns
    assert rows(got) == rows(wanted) and got.count() == n


def test_salts_spread_equal_rows(spark):
    equal = spark.range(10_000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    hot = spark.createDataFrame([(1, 8)], "k int, _salts int")
    got = skew.salted_join(equal, spark.createDataFrame([(1, "x")], "k int, name string"), ["k"], hot=hot)
    plan = layout.plan_text(got)
    assert "_row" in plan and got.count() == 10_000 and got.columns == ["k", "v", "name"]
    numbered = equal.withColumn("_row", F.monotonically_increasing_id())
    assert numbered.select(skew._salt(["_row"], F.lit(8)).alias("s")).distinct().count() == 8


def test_salted_join_copies_nothing_without_hot_keys(spark, rows, monkeypatch):
    kept = []
    monkeypatch.setattr(skew, "written", lambda df, label: kept.append(label) or written(df, label))
    fact = spark.range(200).select(F.col("id").alias("k"), F.lit(1).alias("_row"), F.lit(2).alias("_salt"), F.lit(3).alias("_salts"))
    dim = spark.range(100).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    got = skew.salted_join(fact, dim, ["k"], min_share=0.1)
    assert kept == ["hot-keys"] and rows(got) == rows(fact.join(dim, "k"))
    skewed = fact.withColumn("k", F.when(F.col("k") < 150, F.lit(7)).otherwise(F.col("k")).cast("long"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        got = skew.salted_join(skewed, dim, ["k"], how, min_share=0.1)
        assert got.columns == skewed.join(dim, "k", how).columns and rows(got) == rows(skewed.join(dim, "k", how))
    assert kept[2] == "hot-rows"


@pytest.mark.parametrize("limit", [joins.BROADCAST_BYTES, 50, 0])
@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_lookup_join_gives_the_same_rows_whatever_the_size(spark, rows, limit, how):
    left, right = (written(side.coalesce(1)) for side in _sides(spark))
    got = joins.lookup_join(left, right, ["k"], how, max_broadcast_bytes=limit)
    plan = layout.plan_text(got, "simple")
    assert ("SortMergeJoin" in plan) == (limit == 50)
    assert rows(got) == rows(left.join(right, "k", how))


def test_lookup_join_broadcasts_only_within_the_limit(spark):
    fact = spark.range(1000).select((F.col("id") % 50).alias("k"), "id")
    dim = spark.range(50).select(F.col("id").alias("k"), F.lit("x" * 100).alias("text"))
    assert joins.measured_bytes(dim) >= 50 * 100
    small = layout.plan_text(joins.lookup_join(fact, dim, ["k"]), "simple")
    assert "BroadcastHashJoin" in small and "hashpartitioning" not in small
    large = layout.plan_text(joins.lookup_join(fact, dim, ["k"], max_broadcast_bytes=1000), "simple")
    assert "SortMergeJoin" in large and "Broadcast" not in large


def test_outer_joins_with_a_skewed_side(spark, rows):
    fact = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 90).alias("k"), "id")
    dim = spark.range(5, 120).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    assert rows(joins.keep_all_of_right(fact, dim, ["k"])) == rows(fact.join(dim, "k", "right"))
    assert rows(joins.keep_all(fact, dim, ["k"])) == rows(fact.join(dim, "k", "full"))


def test_a_dimension_made_from_huge_inputs_is_not_read_to_measure_it(spark):
    fact = spark.range(10).select(F.col("id").alias("k"))
    huge = spark.range(10**12).select(F.col("id").alias("k"))
    assert joins.input_bytes(huge) > 10**12
    assert "SortMergeJoin" in layout.plan_text(joins.lookup_join(fact, huge, ["k"], "left"), "simple")


def test_a_hot_partition_of_a_shuffled_join_is_split(spark):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
                "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
                "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        fact = spark.range(0, 200_000, 1, 8).select("id", F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).alias("k"))
        dim = spark.range(5000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 512).alias("text"))
        joined = joins.lookup_join(fact, dim, ["k"], "left", max_broadcast_bytes=1000)
        assert joined.agg(F.count("text")).first()[0] == 200_000
        joined.write.format("noop").mode("overwrite").save()
        counted = joined.groupBy("k").agg(F.count("text").alias("n"))
        counted.collect()
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_measured_bytes_refuses_what_it_cannot_measure(spark):
    nested = spark.range(1).select(F.array(F.lit(1)).alias("a"))
    assert joins.measured_bytes(nested) is None
    assert joins.measured_bytes(spark.range(0)) == 0


# --- skew ---------------------------------------------------------------------------------

def _branches(spark):
    return spark.range(640).select("id", F.when(F.col("id") % 4 == 1, "north").otherwise("south").alias("branch"))


def test_skew_report(spark):
    report = {r.branch: (r.rows, r.share, r.ratio_to_mean) for r in skew.skew_report(_branches(spark), ["branch"]).collect()}
    assert report == {"south": (480, 0.75, 1.5), "north": (160, 0.25, 0.5)}


def test_hot_keys_get_salts_by_their_share(spark):
    hot = {r.branch: r._salts for r in skew.hot_keys(_branches(spark), ["branch"], 0.05).collect()}
    assert hot == {"south": 6, "north": 2}
    assert [r.branch for r in skew.hot_keys(_branches(spark), ["branch"], 0.5).collect()] == ["south"]


def test_a_hot_key_is_spread_over_its_salts(spark):
    spread = _branches(spark).select(skew._salt(["id"], F.lit(8)).alias("s")).groupBy("s").count().collect()
    assert len(spread) == 8 and max(r["count"] for r in spread) < 200


def test_salted_aggregate_equals_the_plain_one(spark, rows):
    df = _branches(spark)
    got = skew.salted_agg(df, ["branch"], {"total": ("sum", "id"), "n": ("count", "id"), "low": ("min", "id"),
                                         "high": ("max", "id")}, salts=7, salt_on=["id"])
    plain = df.groupBy("branch").agg(F.sum("id").alias("total"), F.count("id").alias("n"), F.min("id").alias("low"),
                                   F.max("id").alias("high"))
    assert rows(got) == rows(plain)


# --- ranking ------------------------------------------------------------------------------

def test_ntile_sizes(spark):
    tiles = ranking.spread_ntile(spark.range(11), 5, ["id"], "tile", buckets=4)
    assert [r["count"] for r in tiles.groupBy("tile").count().orderBy("tile").collect()] == [3, 2, 2, 2, 2]


@pytest.mark.parametrize("values, k", [
    (list(range(37)), 5), ([0] * 23, 5), ([1, 2, 3], 5), ([i % 3 for i in range(50)], 4), ([None, 1, None, 2, 2], 2)])
def test_spread_ntile_equals_the_window(spark, rows, values, k):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, v int")
    wanted = df.withColumn("tile", F.ntile(k).over(Window.orderBy(F.desc("v"), "id")))
    for buckets in (1, 3, 8):
        assert rows(ranking.spread_ntile(df, k, ["v desc", "id"], "tile", buckets)) == rows(wanted)


def test_ntile_measures_before_it_uses_one_task(spark, rows):
    df = spark.range(100).select("id", (F.col("id") % 7).alias("v"))
    small = ranking.ntile(df, 5, ["v", "id"], "tile")
    large = ranking.ntile(df, 5, ["v", "id"], "tile", max_task_rows=10)
    assert "ntile" in layout.plan_text(small, "simple") and "ntile" not in layout.plan_text(large, "simple")
    assert rows(small) == rows(large)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.integers(0, 3))), min_size=1, max_size=40),
       st.integers(1, 9))
def test_spread_rank_equals_the_window(spark, rows, data, buckets):
    df = spark.createDataFrame([(i, g, v) for i, (g, v) in enumerate(data)], "id int, g string, v int")
    wanted = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    assert rows(ranking.spread_rank(df, ["g"], ["v desc"], ["id"], "r", buckets)) == rows(wanted)


def test_one_group_over_many_buckets(spark, rows):
    # a hot group and, in it, a hot tie, both larger than any bucket
    df = spark.range(2000).select("id", F.when(F.col("id") < 1500, "hot").otherwise("cold").alias("g"),
                                  F.when(F.col("id") % 2 == 0, 5).otherwise(F.col("id") % 11).alias("v"))
    wanted = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v"))))
    got = ranking.spread_rank(df, ["g"], ["v desc"], ["id"], "r", buckets=16)
    assert rows(got) == rows(wanted)
    assert rows(ranking.rank_in_group(df, ["g"], ["v desc"], ["id"], "r", max_task_rows=100)) == rows(wanted)
    assert rows(ranking.rank_in_group(df, ["g"], ["v desc"], ["id"], "r")) == rows(wanted)


def test_spread_row_number_spreads_ties(spark):
    df = spark.range(1000).select("id", F.lit(1).alias("v"))
    numbered, sizes = ranking._numbered(df, ["v", "id"], 8)
    assert sizes.count() == 8 and sizes.agg(F.max("_size")).first()[0] < 300
    got = ranking.spread_row_number(df, ["v", "id"], "n", 8)
    assert got.filter("n <> id + 1").isEmpty()


def test_top_per_group_keeps_ties_and_null_groups(spark, rows):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 1), (None, 4, 2), ("b", 5, None)], "g string, id int, v int")
    wanted = df.withColumn("r", F.rank().over(Window.partitionBy("g").orderBy(F.desc("v")))).filter("r = 1").drop("r")
    assert rows(ranking.top_per_group(df, ["g"], "v")) == rows(wanted)


# --- aggregates and layout -----------------------------------------------------------------

def test_word_count(spark, rows):
    df = spark.createDataFrame([("a b  a",), ("",)], "value string")
    assert rows(aggregates.word_count(df)) == [("a", 2), ("b", 1)]
    assert [tuple(r) for r in aggregates.top_words(df, k=1).collect()] == [("a", 2)]


def test_describe_matches_spark_describe(spark):
    df = spark.createDataFrame([(50, 1.5), (60, None), (70, 2.5)], "a int, b double")
    got = {r["column"]: r for r in aggregates.describe_numeric(df, ["a", "b"]).collect()}
    wanted = {r["summary"]: r for r in df.describe().collect()}
    for c in ("a", "b"):
        for measure in ("count", "mean", "stddev", "min", "max"):
            assert float(got[c][measure]) == float(wanted[measure][c])


def test_partition_reports(spark):
    even = spark.range(100).repartition(4)
    assert [r.rows for r in layout.rows_per_partition(even).collect()] == [25] * 4
    assert even.coalesce(2).rdd.getNumPartitions() == 2
    by_key = spark.range(100).select((F.col("id") % 2).alias("k")).repartition(4, "k")
    assert layout.rows_per_partition(by_key).count() <= 2


def test_reused_releases_its_table(spark):
    df = spark.range(10)
    with layout.reused(df) as kept:
        assert kept.is_cached and kept.count() == 10
    assert not df.is_cached


def test_rdd_style_work_as_tables(spark):
    numbers = spark.range(1, 11)
    assert [r[0] for r in numbers.select((F.col("id") * 2).alias("x")).orderBy("x").collect()] == list(range(2, 21, 2))
    assert numbers.agg(F.sum("id")).first()[0] == 55
    doubled = numbers.mapInPandas(lambda parts: (p.assign(id=p.id * 2) for p in parts), "id long").toDF("twice")
    assert doubled.agg(F.sum("twice")).first()[0] == 110


def test_layouts_are_checked(spark):
    df = spark.range(1_000).select((F.col("id") % 37).alias("k"), "id")
    assert layout.keys_whole(df.repartition(5, "k"), ["k"]).first()[0] and not layout.keys_whole(df.repartition(5), ["k"]).first()[0]
    assert layout.ranges_apart(df.repartitionByRange(5, "id"), "id").first()[0] and not layout.ranges_apart(df.repartition(5), "id").first()[0]
