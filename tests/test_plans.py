import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tradeloom.operators import quality
from tradeloom.operators.layout import plan_text
from tradeloom.plans import employees, leakage, rfm, rollups, segments, sessions, silver

CLICKS = "event_id string, session_id string, user_id string, device_type string, event_type string, event_timestamp string, product_id string, payment_status string"


def clicks(spark, data):
    return spark.createDataFrame(data, CLICKS).withColumn("event_timestamp", F.col("event_timestamp").cast("timestamp"))


SESSION = [("e4", "s", "u", "web", "payment_attempt", "2024-01-01 10:06:00", "p2", "success"),
           ("e2", "s", "u", "app", "add_to_cart", "2024-01-01 10:01:00", "p2", None),
           ("e1", "s", "u", "mobile", "view", "2024-01-01 10:00:00", "p1", None),
           ("e3", "s", "u", "web", "payment_attempt", "2024-01-01 10:05:00", "p2", "failed")]


def test_session_stitching(spark):
    got = sessions.stitch_sessions(clicks(spark, SESSION).repartition(4)).first()
    assert (got.session_start, got.session_end) == (datetime(2024, 1, 1, 10, 0), datetime(2024, 1, 1, 10, 6))
    assert (got.num_events, got.session_duration_secs) == (4, 360)
    assert (got.funnel_stage_reached, got.payment_status) == ("payment_attempted", "success")
    assert (got.device_type, got.first_product_id) == ("mobile", "p1")


@pytest.mark.parametrize("event, stage", [("view", "browse_only"), ("add_to_cart", "cart_abandoned"),
                                          ("checkout_start", "checkout_started"), ("purchase", "purchased"), ("other", "browse_only")])
def test_stage_names(spark, event, stage):
    got = sessions.stitch_sessions(clicks(spark, [("e", "s", "u", "web", event, "2024-01-01 10:00:00", "p", None)]))
    assert got.first().funnel_stage_reached == stage
    assert [tuple(r) for r in sessions.funnel_counts(got).collect()] == [(stage, 1)]


ORDERS = "order_id string, session_id string, user_id string, product_id string, order_timestamp string, quantity string, unit_price string, discount_pct string, payment_method string, order_status string, return_timestamp string, _ingested_at int"


def order(oid, user="u1", product="p1", qty="1", price="10", at="2024-01-01 00:00:00", seen=1):
    return (oid, "s", user, product, at, qty, price, "0.1", "card", "completed", None, seen)


def test_silver_orders_accepts_and_rejects_with_reasons(spark):
    raw = spark.createDataFrame([
        order("o1"), order("o1", qty="3", seen=2), order(None), order("o2", qty="0"), order("o3", qty="x"), order("o4", price=None),
        order("o5", user="nobody"), order("o6", product="nothing"), order("o7", at="bad"), order("o8", user=None, qty="0")], ORDERS)
    users, products = (spark.createDataFrame([(v,)], f"{c} string") for v, c in (("u1", "user_id"), ("p1", "product_id")))
    tagged = silver.orders(raw, users, products)
    good = {r.order_id: r for r in quality.accepted(tagged).collect()}
    assert set(good) == {"o1", "o7"}
    assert good["o1"].quantity == 3 and good["o1"].net_amount == Decimal("27.00")
    assert good["o7"].order_timestamp is None
    bad = {r.order_id: r[quality.REASONS] for r in quality.rejected(tagged).collect()}
    assert bad == {None: ["order_id"], "o2": ["quantity"], "o3": ["quantity"], "o4": ["unit_price"],
                   "o5": ["unknown_user_id"], "o6": ["unknown_product_id"], "o8": ["quantity", "unknown_user_id"]}


def test_silver_dimensions(spark):
    users = spark.createDataFrame([("u1", "n", " A@B.C ", "x", "y", "2024-01-31", "web", 1), ("u1", "n", "new@B.C", "x", "y", "soon", "web", 2),
                                   (None, "n", "e", "x", "y", None, "web", 1)],
                                  "user_id string, name string, email string, city string, state string, signup_date string, preferred_device string, _ingested_at int")
    good = quality.accepted(silver.users(users)).collect()
    assert [(r.user_id, r.email, r.signup_date) for r in good] == [("u1", "new@b.c", None)]
    products = spark.createDataFrame([("p1", "n", " Books ", "s", "b", "10.005", 1), ("p2", "n", "c", "s", "b", "cheap", 1)],
                                     "product_id string, product_name string, category string, sub_category string, brand string, list_price string, _ingested_at int")
    tagged = silver.products(products)
    assert [(r.category, r.list_price) for r in quality.accepted(tagged).collect()] == [("Books", Decimal("10.01"))]
    assert [r.product_id for r in quality.rejected(tagged).collect()] == ["p2"]


def test_silver_clickstream(spark):
    raw = spark.createDataFrame([("e1", "s", "u1", "web", "view", "2024-01-01 00:00:00", "p1", None, 1), ("e2", None, "u1", "web", "view", "2024-01-01 00:00:00", "p1", None, 1),
                                 ("e3", "s", "u1", "web", "view", "bad", "p1", None, 1), ("e4", "s", "u9", "web", "view", "2024-01-01 00:00:00", "p1", None, 1)],
                                CLICKS + ", _ingested_at int")
    users, products = (spark.createDataFrame([(v,)], f"{c} string") for v, c in (("u1", "user_id"), ("p1", "product_id")))
    tagged = silver.clickstream(raw, users, products)
    assert [r.event_id for r in quality.accepted(tagged).collect()] == ["e1"]
    assert {r.event_id: r[quality.REASONS] for r in quality.rejected(tagged).collect()} == {
        "e2": ["session_id"], "e3": ["event_timestamp"], "e4": ["unknown_user_id"]}


FIVE = [("u1", 1, 9, "900"), ("u2", 10, 7, "700"), ("u3", 20, 5, "500"), ("u4", 30, 3, "300"), ("u5", 40, 1, "100")]


def five(spark):
    return spark.createDataFrame(FIVE, "user_id string, recency_days int, frequency long, monetary string").withColumn(
        "monetary", F.col("monetary").cast("decimal(18,2)"))


SEGMENTS = ["Champions", "Loyal Customers", "Potential Loyalists", "At Risk", "Lost / Hibernating"]


@pytest.mark.parametrize("method", ["auto", "window", "spread"])
def test_rfm_scores(spark, method):
    got = rfm.score(five(spark), method=method).orderBy("user_id").collect()
    assert [(r.rfm_score, r.rfm_segment) for r in got] == list(zip([15, 12, 9, 6, 3], SEGMENTS))


def test_rfm_reversed_scale(spark):
    got = rfm.score(five(spark), orientation="reference").orderBy("user_id").collect()
    assert [(r.rfm_score, r.rfm_segment) for r in got] == list(zip([3, 6, 9, 12, 15], SEGMENTS[::-1]))


def test_rfm_is_spread_beyond_the_limit_with_the_same_scores(spark, rows):
    many = spark.range(500).select(F.col("id").cast("string").alias("user_id"), (F.col("id") % 13).cast("int").alias("recency_days"),
                                   F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7).cast("long").alias("frequency"),
                                   (F.col("id") % 101).cast("decimal(18,2)").alias("monetary"))
    spread = rfm.score(many, max_task_rows=50)
    assert rows(spread, "user_id", "rfm_score") == rows(rfm.score(many, method="window"), "user_id", "rfm_score")
    assert "ntile" not in plan_text(spread, "simple")
    with pytest.raises(ValueError):
        rfm.score(many, method="guess")


def buys(spark):
    return spark.createDataFrame(
        [("o1", "u1", "2024-01-01 12:00:00", "completed", "10.00"), ("o2", "u1", "2024-01-05 00:00:00", "returned", "99.00"),
         ("o3", "u2", "2024-01-11 01:00:00", "returned", "5.00")],
        "order_id string, user_id string, order_timestamp string, order_status string, net_amount string").withColumns(
        {"order_timestamp": F.col("order_timestamp").cast("timestamp"), "net_amount": F.col("net_amount").cast("decimal(18,2)")})


def test_rfm_measures_use_completed_orders_and_the_date_of_all(spark, rows):
    assert rows(rfm.measures(buys(spark))) == [("u1", 10, 1, Decimal("10.00"))]
    assert rows(rfm.measures(buys(spark), frequency_includes_returns=True)) == [("u1", 10, 2, Decimal("10.00"))]
    assert rows(rfm.measures(buys(spark), as_of_time=datetime(2024, 1, 2))) == [("u1", 1, 1, Decimal("10.00"))]
    assert "CartesianProduct" not in (plan := plan_text(rfm.measures(buys(spark)))) and "NestedLoop" not in plan


def test_customer_360_defaults(spark, rows):
    users = spark.createDataFrame([("u1", "n", "c", "s", "web"), ("u9", "n", "c", "s", "web")],
                                  "user_id string, name string, city string, state string, preferred_device string")
    got = rfm.customer_360(users, rfm.score(five(spark)))
    never = got.filter("user_id = 'u9'").first()
    assert tuple(never)[5:] == (9999, 0, Decimal("0.00"), None, None, None, 0, "Never Purchased")
    assert rows(rfm.segment_distribution(got)) == [("Champions", 1), ("Never Purchased", 1)]
    assert rows(rollups.in_segments(got, ["Champions"]), "user_id") == [("u1",)]
    assert rollups.in_segments(got, []).count() == 2
    assert rows(rollups.segment_names(got)) == [("Champions",), ("Never Purchased",)]


def test_leakage(spark, rows):
    day = datetime(2024, 1, 2, 3)
    stitched = spark.createDataFrame(
        [("s1", day, "p1", "cart_abandoned", None), ("s2", day, "p2", "payment_attempted", "failed"),
         ("s3", day, "p2", "payment_attempted", "success"), ("s4", day, "p1", "checkout_started", None),
         ("s5", day, "p?", "cart_abandoned", None)],
        "session_id string, session_start timestamp, first_product_id string, funnel_stage_reached string, payment_status string")
    products = spark.createDataFrame([("p1", "100"), ("p2", "250")], "product_id string, list_price string").withColumn(
        "list_price", F.col("list_price").cast("decimal(18,2)"))
    orders = spark.createDataFrame([("returned", day, "90"), ("completed", None, "70")],
                                   "order_status string, return_timestamp timestamp, net_amount string").withColumn(
        "net_amount", F.col("net_amount").cast("decimal(18,2)"))
    daily = leakage.revenue_leakage_daily(stitched, products, orders)
    d = date(2024, 1, 2)
    assert rows(daily) == [(d, "abandoned_cart", 2, Decimal("100.00")), (d, "failed_payment", 1, Decimal("250.00")),
                           (d, "return", 1, Decimal("90.00"))]
    assert [r.leakage_type for r in leakage.leakage_totals(daily).collect()] == ["failed_payment", "abandoned_cart", "return"]
    customers = spark.createDataFrame([("Champions", 10), ("At Risk", 5)], "rfm_segment string, monetary int")
    assert rows(rollups.kpis(customers, daily)) == [(2, 15, Decimal("440.00"), 1)]


def test_category_rollup(spark, rows):
    orders = spark.createDataFrame(
        [("o1", "p1", 2, "10", "completed"), ("o2", "p1", 1, "5", "completed"), ("o3", "p1", 1, "5", "returned"), ("o4", "p2", 1, "1", "completed")],
        "order_id string, product_id string, quantity int, net_amount string, order_status string").withColumns(
        {"net_amount": F.col("net_amount").cast("decimal(18,2)"), "order_timestamp": F.lit("2024-01-01 23:59:59").cast("timestamp")})
    products = spark.createDataFrame([("p1", "c", "s"), ("p2", "c", "t")], "product_id string, category string, sub_category string")
    rollup = rollups.daily_category_rollup(orders, products)
    d = date(2024, 1, 1)
    assert rows(rollup) == [(d, "c", "s", 2, 3, Decimal("15.00")), (d, "c", "t", 1, 1, Decimal("1.00"))]
    assert rows(rollups.daily_revenue(rollup)) == [(d, "c", Decimal("16.00"))]
    assert rows(rollups.category_totals(rollup)) == [("c", Decimal("16.00"))]


STAFF = [(1, "Ada", "Build", 91_000.0, "Oslo"), (2, "Bo", "Build", 72_000.0, "Rome"), (3, "Cy", "Sell", 72_000.0, "Oslo"),
         (4, "Di", "Sell", 60_000.0, "Oslo"), (5, "Ed", "Build", 91_000.0, "Rome")]


def test_salary_report(spark, folder):
    source = spark.createDataFrame(STAFF, "emp_id int, name string, department string, salary double, city string")
    source.write.option("header", True).csv(f"{folder}/in")
    employees.run(spark.read.option("header", True).option("inferSchema", True).csv(f"{folder}/in"), f"{folder}/out")
    enriched = {r.emp_id: (r.salary_grade, r.dept_rank) for r in spark.read.parquet(f"{folder}/out/enriched_employees").collect()}
    assert enriched == {1: ("Senior", 1), 5: ("Senior", 1), 2: ("Mid", 3), 3: ("Mid", 1), 4: ("Junior", 2)}
    summary = {r.department: tuple(r)[1:] for r in spark.read.option("header", True).option("inferSchema", True)
               .csv(f"{folder}/out/dept_summary_csv").collect()}
    assert summary == {"Build": (3, 84666.67, 91000.0, 72000.0, 2, 1, 0), "Sell": (2, 66000.0, 72000.0, 60000.0, 0, 1, 1)}
    cities = {r.city: (r.employee_count, r.avg_salary) for r in spark.read.json(f"{folder}/out/city_summary_json").collect()}
    assert cities == {"Oslo": (3, 74333.33), "Rome": (2, 81500.0)}


def features(spark, n=120):
    return spark.range(n).select(
        F.col("id").cast("string").alias("user_id"), (F.col("id") % 4 * 50).cast("int").alias("recency_days"),
        (F.col("id") % 4 * 10 + 1).alias("frequency"), ((F.col("id") % 4) * 1000 + F.col("id")).cast("decimal(18,2)").alias("monetary"),
        (F.col("id") % 4).alias("num_sessions"), (F.col("id") % 4 * 60).cast("double").alias("avg_session_duration_secs"),
        F.lit(0.25).alias("cart_abandonment_rate"))


def test_buyers_without_sessions_get_zeros(spark):
    customers = spark.createDataFrame([("u1", 2), ("u2", 0)], "user_id string, frequency int")
    stitched = spark.createDataFrame([("u3", 60, "cart_abandoned")], "user_id string, session_duration_secs long, funnel_stage_reached string")
    got = segments.customer_features(customers, stitched).collect()
    assert [(r.user_id, r.num_sessions, r.avg_session_duration_secs, r.cart_abandonment_rate) for r in got] == [("u1", 0, 0.0, 0.0)]


def test_clusters_keep_every_customer_and_order_labels_by_spend(spark):
    got = segments.cluster_customers(features(spark))
    assert got.count() == 120 and got.select("user_id").distinct().count() == 120
    means = got.groupBy("segment_label").agg(F.avg("monetary").alias("m")).orderBy(F.desc("m")).collect()
    assert [r.segment_label for r in means] == segments.LABELS
    assert sum(r.customers for r in segments.segment_sizes(got).collect()) == 120
    assert segments.segment_points(got).count() == 120


def test_more_clusters_than_labels(spark):
    six = spark.range(6).select("id", F.col("id").alias("monetary"), F.col("id").alias("frequency"))
    labels = [r.segment_label for r in segments.rank_groups(six, "id").orderBy("rank").collect()]
    assert labels == segments.LABELS + ["Segment 5", "Segment 6"]


def test_scaled_features_have_mean_0_and_deviation_1(spark):
    from pyspark.ml.functions import vector_to_array
    scaled = segments.scaled_features(features(spark)).select(vector_to_array("scaled_features").alias("v"))
    for i in range(3):
        mean, deviation = scaled.agg(F.avg(F.col("v")[i]), F.stddev_samp(F.col("v")[i])).first()
        assert abs(mean) < 1e-9 and abs(deviation - 1) < 1e-9


def test_silhouette_equals_brute_force(spark):
    r = random.Random(4)
    points = [(i % 3 if i else 3, [r.gauss(3 * (i % 3), 1), r.gauss(0, 1)]) for i in range(40)]

    def far(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b))

    scores = []
    for i, (c, x) in enumerate(points):
        mean = {k: [far(x, y) for j, (d, y) in enumerate(points) if d == k and j != i] for k in range(4)}
        if not mean[c]:
            scores.append(0.0)
            continue
        inside, outside = sum(mean[c]) / len(mean[c]), min(sum(v) / len(v) for k, v in mean.items() if k != c and v)
        scores.append((outside - inside) / max(inside, outside))
    df = spark.createDataFrame([(c, Vectors.dense(x)) for c, x in points], ["prediction", "scaled_features"])
    assert segments.silhouette(df).first()[0] == pytest.approx(sum(scores) / len(scores))


def test_elbow(spark):
    scaled = segments.scaled_features(features(spark)).persist()
    got = segments.elbow(scaled, range(2, 5)).collect()
    scaled.unpersist()
    assert [r.k for r in got] == [2, 3, 4] and all(r.wssse >= 0 and -1 <= r.silhouette <= 1 for r in got)


def test_rows_without_a_key_are_all_rejected_and_an_overflow_is_one_reject(spark):
    raw = spark.createDataFrame([order(None) for _ in range(100)] + [order("o1"), order("o1", seen=2),
                                order("o2", qty="2000000000", price="9999999999.99")], ORDERS)
    users, products = (spark.createDataFrame([(v,)], f"{c} string") for v, c in (("u1", "user_id"), ("p1", "product_id")))
    tagged = silver.orders(raw, users, products)
    assert [r.order_id for r in quality.accepted(tagged).collect()] == ["o1"]
    bad = [(r.order_id, tuple(r[quality.REASONS])) for r in quality.rejected(tagged).collect()]
    assert bad.count((None, ("order_id",))) == 100 and bad.count(("o2", ("net_amount",))) == 1 and len(bad) == 101
