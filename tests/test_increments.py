"""Batches merged day by day equal a rebuild from all batches; damaged lines never become good rows."""

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import quality
from tradeloom.operators.layout import plan_text
from tradeloom.plans import increments, silver
from tradeloom.schemas import CLICKS_RAW, ORDERS_RAW, PRODUCTS_RAW, USERS_RAW
from tradeloom.sources import files

RAW = ", ".join(f"{f.name} string" for f in ORDERS_RAW) + ", _ingested_at int, _batch_id string"


def order(oid, batch, day="01", user="u1", product="p1", qty="1"):
    at = None if day is None else f"2024-01-{day} 10:00:00"
    return (oid, "s", user, product, at, qty, "10", "0.1", "card", "completed", None, int(batch[1:]), batch)


BATCHES = {
    "b1": [order("o1", "b1"), order("o2", "b1", "02"), order("o3", "b1", "03"), order("o4", "b1", "04", user="u2"), order("o5", "b1", "05", qty="x"),
           order(None, "b1", "06"), order(None, "b1", "06"), order("o9", "b1", "09"), order("o7", "b1", None)],
    # moved to another day; replaced by a bad copy; new; a copy of its own batch; without a key
    "b2": [order("o2", "b2", "07"), order("o3", "b2", "03", qty="0"), order("o6", "b2", "02"), order("o6", "b2", "02", qty="5"), order(None, "b2", "06")],
    "b3": [order("o5", "b3", "05", qty="4"), order("o8", "b3", "08", product="p9"), order("o7", "b3", None, qty="2")],
}
KNOWN = {"b1": ["u1"], "b2": ["u1", "u2"], "b3": ["u1", "u2"]}


def one_column(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def both_sides(df):
    return sorted((str(r.order_id), str(r.order_timestamp), r.quantity, str(r.net_amount), sorted(r[quality.REASONS])) for r in df.collect())


def apply(spark, path, batch, rows=None):
    users, products = one_column(spark, "user_id", KNOWN[batch]), one_column(spark, "product_id", ["p1"])
    tagged = silver.orders(spark.createDataFrame(rows or BATCHES[batch], RAW), users, products)
    return increments.apply_batch(spark, path, tagged, ["order_id"], F.col("order_timestamp"), batch,
                                  lambda stored: silver.tag_known(stored, users, products))


def rebuilt(spark, upto):
    rows = [r for b, batch in BATCHES.items() if b <= upto for r in batch]
    users, products = one_column(spark, "user_id", KNOWN[upto]), one_column(spark, "product_id", ["p1"])
    return both_sides(silver.orders(spark.createDataFrame(rows, RAW), users, products))


def test_batches_equal_a_rebuild(spark, folder):
    path = f"{folder}/orders"
    assert apply(spark, path, "b1")
    days = apply(spark, path, "b2")
    # the day that an order left, the one it came to, and that of a user who is known by now; no other
    assert {d.day for d in days} == {2, 3, 4, 6, 7}
    assert both_sides(spark.read.parquet(path)) == rebuilt(spark, "b2")
    days = apply(spark, path, "b3")
    assert None in days and {d.day for d in days if d} == {5, 8}
    assert both_sides(spark.read.parquet(path)) == rebuilt(spark, "b3")
    good, bad = increments.read_sides(spark, path)
    assert good.count() == 7 and not {increments.DAY, increments.BATCH} & {*good.columns, *bad.columns}
    # the same batch once more changes nothing
    apply(spark, path, "b3")
    assert both_sides(spark.read.parquet(path)) == rebuilt(spark, "b3")


def test_only_touched_days_are_read(spark, folder):
    path = f"{folder}/orders"
    apply(spark, path, "b1")
    stored = spark.read.parquet(path)
    plan = plan_text(stored.where(increments.in_days([r[0] for r in stored.where("order_id = 'o2'").select(increments.DAY).collect()])))
    assert "PartitionFilters" in plan and increments.DAY in plan.split("PartitionFilters")[1].split("]")[0]
    assert stored.where(increments.in_days([None])).count() == 1


def test_silver_reads_its_input_once(spark, folder):
    spark.createDataFrame(BATCHES["b1"], RAW).write.parquet(f"{folder}/raw")
    tagged = silver.users(spark.read.parquet(f"{folder}/raw").withColumns({c: F.lit("x") for c in USERS_RAW.fieldNames() if c != "user_id"}))
    assert plan_text(tagged).count(") Scan parquet") == 1


LINES = {
    "users": (USERS_RAW, silver.users, "user_id", ["U1,n,a@b.c,x,y,2024-01-01,web", "U2,Doe, Jane,j@c,x,y,2024-01-01,web,extra,more", "U3,short", "U1,late"], {"U1"}),
    "products": (PRODUCTS_RAW, silver.products, "product_id", ["P1,n,c,s,b,10.00", "P2,n,c,s,b,10.00,more", "P3,n", "P1"], {"P1"}),
}


@pytest.mark.parametrize("name", LINES)
def test_damaged_csv_lines_are_rejected(spark, folder, name):
    schema, clean, key, lines, good = LINES[name]
    with open(f"{folder}/{name}.csv", "w") as f:
        f.write("\n".join([",".join(schema.fieldNames()), *lines]) + "\n")
    raw = files.read_csv(spark, f"{folder}/{name}.csv", schema).withColumn("_ingested_at", F.lit(1))
    tagged = clean(raw)
    assert {r[key] for r in quality.accepted(tagged).collect()} == good and tagged.count() == len(lines)
    bad = quality.rejected(tagged).collect()
    assert {r[files.CORRUPT] for r in bad} == set(lines[1:]) and all("malformed" in r[quality.REASONS] for r in bad)


def test_damaged_facts_are_rejected(spark, folder):
    users, products = one_column(spark, "user_id", ["u1"]), one_column(spark, "product_id", ["p1"])
    with open(f"{folder}/orders.csv", "w") as f:
        f.write(",".join(ORDERS_RAW.fieldNames()) + "\no1,s,u1,p1,2024-01-01 00:00:00,1,2.00,0.1,card,completed,\no1,s,u1,p1,2024-01-01 00:00:00,1,2.00,0.1,card,completed,,x\n")
    raw = files.read_csv(spark, f"{folder}/orders.csv", ORDERS_RAW).withColumn("_ingested_at", F.lit(1))
    tagged = silver.orders(raw, users, products)
    assert [(r.order_id, r[quality.REASONS]) for r in tagged.orderBy(F.size(quality.REASONS)).collect()] == [("o1", []), ("o1", ["malformed"])]
    with open(f"{folder}/clicks.json", "w") as f:
        f.write('{"event_id": "e1", "session_id": "s", "user_id": "u1", "event_timestamp": "2024-01-01 00:00:00", "product_id": "p1"}\n{"event_id": "e1", "ses\n')
    raw = files.read_json(spark, f"{folder}/clicks.json", CLICKS_RAW).withColumn("_ingested_at", F.lit(1))
    tagged = silver.clickstream(raw, users, products)
    assert quality.accepted(tagged).count() == 1 and "malformed" in quality.rejected(tagged).first()[quality.REASONS]
