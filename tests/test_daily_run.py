from decimal import Decimal

from pyspark.sql import functions as F

from tradeloom.operators import quality
from tradeloom.plans import daily_run
from tradeloom.schemas import CLICKS_RAW, ORDERS_RAW, PRODUCTS_RAW, USERS_RAW


def raw(spark, base, users):
    def put(name, rows, schema):
        df = spark.createDataFrame(rows, schema).coalesce(1)
        writer = df.write.mode("overwrite")
        writer.json(f"{base}/raw/{name}") if name == "clickstream" else writer.option("header", True).csv(f"{base}/raw/{name}")

    put("users", users, USERS_RAW)
    put("products", [(f"P{i}", f"thing {i}", " Books ", "Fiction", "b", str(10 * i + 9)) for i in range(3)]
        + [("P9", "x", "c", "s", "b", "free")], PRODUCTS_RAW)
    orders, clicks = [], []
    for i in range(40):
        user, product, day = f"U{i % 8}", f"P{i % 3}", f"2024-01-{i % 20 + 1:02d}"
        returned = i % 10 == 0
        orders.append((f"O{i}", f"S{i}", user, product, f"{day} 10:00:00", str(i % 3 + 1), "20.00", "0.10", "card",
                       "returned" if returned else "completed", f"{day} 12:00:00" if returned else None))
        clicks += [(f"S{i}-v", f"S{i}", user, "web", "view", f"{day} 09:00:00", product, None),
                   (f"S{i}-c", f"S{i}", user, "web", "add_to_cart", f"{day} 09:01:00", product, None)]
    orders += [("O90", "S", "nobody", "P0", "2024-01-01 00:00:00", "1", "1", "0", "card", "completed", None),
               ("O91", "S", "U1", "P0", "2024-01-01 00:00:00", "none", "1", "0", "card", "completed", None)]
    put("orders", orders, ORDERS_RAW)
    put("clickstream", clicks, CLICKS_RAW)


def people(city):
    return [(f"U{i}", f"n{i}", f" U{i}@X.COM", city, "st", "2023-05-01", "web") for i in range(9)]


def test_whole_run_twice(spark, folder):
    raw(spark, folder, people("Oslo"))
    exported = daily_run.run(spark, folder, "b1")
    tables = daily_run.Tables(spark, folder)
    assert exported["customer_360"] == 9 and exported["customer_segments_kmeans"] == 8
    orders = tables.fact("orders")
    assert orders.count() == 40
    assert {r.order_id: r[quality.REASONS] for r in tables.rejects("orders").collect()} == {
        "O90": ["unknown_user_id"], "O91": ["quantity"]}
    revenue = tables.read("gold", "daily_category_rollup").agg(F.sum("revenue")).first()[0]
    assert revenue == orders.filter("order_status = 'completed'").agg(F.sum("net_amount")).first()[0]
    lost = {r.leakage_type: r.n for r in tables.read("gold", "revenue_leakage_daily").groupBy("leakage_type")
            .agg(F.sum("num_incidents").alias("n")).collect()}
    assert lost == {"abandoned_cart": 40, "return": 4}
    never = tables.read("gold", "customer_360").filter("user_id = 'U8'").first()
    assert never.rfm_segment == "Never Purchased" and never.monetary == Decimal("0.00")

    # the next day's files: a new city for everybody, the same facts again
    raw(spark, folder, people("Rome"))
    assert daily_run.run(spark, folder, "b2") == exported
    assert tables.fact("orders").count() == 40
    users = tables.dimension("users")
    assert {r.city for r in users.read().collect()} == {"Rome"}
    assert {r.city for r in users.read_as_of(0).collect()} == {"Oslo"}
    assert spark.read.option("header", True).csv(f"{folder}/exports/customer_360_csv").count() == 9
    assert tables.read("bronze", "users").count() == 18
    assert {(r.product_id, r._batch_id) for r in tables.rejects("products").collect()} == {("P9", "b1"), ("P9", "b2")}


def test_batch_ids_may_hold_any_characters(spark, folder):
    raw(spark, folder, people("Oslo"))
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(f"{folder}/raw/clickstream")
    tables = daily_run.Tables(spark, folder)
    daily_run.to_bronze(tables, "2024-05-01T10:00")
    daily_run.to_silver(tables, "2024-05-01T10:00")
    assert tables.arrived("users", "2024-05-01T10:00").count() == 9 and tables.arrived("users", "other").count() == 0
    assert tables.current("users").columns == ["user_id", "name", "email", "city", "state", "signup_date", "preferred_device"]
    assert {r.product_id: r._source_file.rsplit("/", 2)[1] for r in tables.rejects("products").collect()} == {"P9": "products"}
    assert [r._corrupt_record for r in tables.rejects("clickstream").collect()] == ["not json"]
