import json
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.schemas import ENVELOPE
from tradeloom.streaming import messages, orders

DAY = datetime(2024, 1, 1)


def payload(oid, qty=2, price=5.0, status="success"):
    return json.dumps({"order_id": oid, "user_id": "u", "product_id": "p", "quantity": qty, "unit_price": price,
                       "payment_method": "card", "payment_status": status, "order_timestamp": "2024-01-01 00:00:00"})


def batch(spark, feed, *rows):
    """Append one file of (value, seconds after the day's start)."""
    data = [(b"k", value.encode(), datetime.fromtimestamp(DAY.timestamp() + at)) for value, at in rows]
    spark.createDataFrame(data, ENVELOPE).coalesce(1).write.mode("append").parquet(feed)


def at(seconds):
    return datetime.fromtimestamp(DAY.timestamp() + seconds)


def test_decode_is_the_same_for_batch_and_stream(spark, folder, rows):
    batch(spark, f"{folder}/feed", (payload("o1", 3, 1.005), 1), ("{bad", 2), (payload(None), 3))
    table = orders.decode_orders(spark.read.parquet(f"{folder}/feed"))
    good = orders.well_formed(table).collect()
    assert [(r.order_id, r.unit_price, r.net_amount, r.order_timestamp) for r in good] == [
        ("o1", Decimal("1.01"), Decimal("3.03"), DAY)]
    assert [r.raw_value for r in orders.malformed(table).orderBy("kafka_ingest_ts").collect()] == ["{bad", payload(None)]
    stream = orders.decode_orders(messages.file_messages(spark, f"{folder}/feed"))
    assert stream.isStreaming and stream.schema == table.schema
    query = (stream.writeStream.format("memory").queryName("decoded").option("checkpointLocation", f"{folder}/c")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    assert rows(spark.table("decoded")) == rows(table)


def windows(spark, feed, folder, mode):
    stream = orders.well_formed(orders.decode_orders(messages.file_messages(spark, feed, files_per_batch=1)))
    query = orders.start_metrics(stream, f"{folder}/{mode}-c", mode, f"{folder}/{mode}", available_now=True)
    query.awaitTermination()
    dropped = sum(s.numRowsDroppedByWatermark for p in query.recentProgress for s in p.stateOperators)
    out = spark.read.parquet(f"{folder}/{mode}").orderBy("window").collect()
    return [(r.window.start, r.orders_in_window) for r in out], dropped, out


def test_late_rows_count_in_complete_mode_and_are_dropped_in_append_mode(spark, folder):
    import time
    feed = f"{folder}/feed"
    for i, second in enumerate((5, 605, 606, 6, 1200, 1201)):
        batch(spark, feed, (payload(f"o{i}", status="failed" if i == 0 else "success"), second))
        time.sleep(0.05)  # files are taken in the order they were written
    counted, dropped, out = windows(spark, feed, folder, "complete")
    assert counted == [(at(0), 2), (at(600), 2), (at(1200), 2)] and dropped == 0
    assert (out[0].revenue_in_window, out[0].failure_rate) == (Decimal("20.00"), 0.5)
    counted, dropped, _ = windows(spark, feed, folder, "append")
    assert counted == [(at(0), 1), (at(600), 2)] and dropped == 1


def test_update_mode_gives_a_window_again_when_it_changes(spark, folder):
    import time
    feed = f"{folder}/feed"
    for second in (1, 2):
        batch(spark, feed, (payload(f"o{second}"), second))
        time.sleep(0.05)
    stream = orders.well_formed(orders.decode_orders(messages.file_messages(spark, feed, files_per_batch=1)))
    query = (orders.window_metrics(stream).writeStream.outputMode("update").format("memory").queryName("updates")
             .option("checkpointLocation", f"{folder}/c").trigger(availableNow=True).start())
    query.awaitTermination()
    assert sorted(r.orders_in_window for r in spark.table("updates").collect()) == [1, 2]


def land(spark, folder):
    orders.start_landing(messages.file_messages(spark, f"{folder}/feed"), f"{folder}/store", f"{folder}/c",
                         available_now=True).awaitTermination()
    return [(r.order_id, r.net_amount) for r in orders.landed(spark, f"{folder}/store").orderBy("order_id").collect()]


def test_landing_has_one_row_per_order(spark, folder):
    # twice in one batch, then again after a restart
    batch(spark, f"{folder}/feed", (payload("o1", 1), 1), (payload("o1", 2), 9), (payload("o2", 1), 2), ("{bad", 3))
    assert land(spark, folder) == [("o1", Decimal("10.00")), ("o2", Decimal("5.00"))]
    assert [r.raw_value for r in orders.quarantined(spark, f"{folder}/store").collect()] == ["{bad"]
    batch(spark, f"{folder}/feed", (payload("o2", 4), 20), (payload("o3", 1), 21))
    assert land(spark, folder) == [("o1", Decimal("10.00")), ("o2", Decimal("20.00")), ("o3", Decimal("5.00"))]
    assert land(spark, folder) == [("o1", Decimal("10.00")), ("o2", Decimal("20.00")), ("o3", Decimal("5.00"))]


def test_replayed_batch_replaces_itself(spark, folder):
    batch(spark, f"{folder}/feed", (payload("o1"), 1), ("{bad", 3))
    batch_rows = spark.read.parquet(f"{folder}/feed")
    write = orders._land(f"{folder}/store")
    for _ in range(2):
        write(batch_rows, 0)
    store = orders.landed(spark, f"{folder}/store")
    assert store.count() == 1 and store.columns == orders.well_formed(orders.decode_orders(batch_rows)).columns
    assert orders.quarantined(spark, f"{folder}/store").count() == 1


def test_fresh_checkpoint_lands_beside_the_old_one(spark, folder):
    batch(spark, f"{folder}/feed", (payload("o1"), 1), ("{bad", 2))
    first = land(spark, folder)
    orders.start_landing(messages.file_messages(spark, f"{folder}/feed"), f"{folder}/store", f"{folder}/other",
                         available_now=True).awaitTermination()
    assert [(r.order_id, r.net_amount) for r in orders.landed(spark, f"{folder}/store").collect()] == first
    assert orders.quarantined(spark, f"{folder}/store").count() == 2


def test_landing_a_batch_reads_no_other(spark, folder):
    write = orders._land(f"{folder}/store")
    for i in range(3):
        batch(spark, f"{folder}/feed{i}", (payload("o1", i + 1), i))
        write(spark.read.parquet(f"{folder}/feed{i}"), i)
    assert [r.quantity for r in orders.landed(spark, f"{folder}/store").collect()] == [3]
    assert [r.quantity for r in orders.landed(spark, f"{folder}/store", up_to_batch=1).collect()] == [2]


def test_two_queries_over_one_feed(spark, folder):
    batch(spark, f"{folder}/feed", (payload("o1"), 1), (payload("o2"), 2))
    started = orders.start_live(messages.file_messages(spark, f"{folder}/feed"), f"{folder}/store", f"{folder}/c",
                                available_now=True)
    for query in started:
        query.awaitTermination()
    assert len({q.id for q in started}) == 2
    assert orders.landed(spark, f"{folder}/store").count() == 2
    assert "Console" in started[1].lastProgress.sink.description


def test_json_lines_land_too(spark, folder):
    spark.createDataFrame([(payload("o1"),), (payload("o2"),), ("nonsense",)], "value string").write.text(f"{folder}/feed")
    feed = messages.line_messages(spark, f"{folder}/feed")
    assert feed.columns == ["key", "value", "timestamp"]
    orders.start_landing(feed, f"{folder}/store", f"{folder}/c", available_now=True).awaitTermination()
    landed = orders.landed(spark, f"{folder}/store").collect()
    assert sorted(r.order_id for r in landed) == ["o1", "o2"] and all(r.kafka_ingest_ts for r in landed)
    assert orders.quarantined(spark, f"{folder}/store").count() == 1


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        messages.kafka_messages(spark, "localhost:9092", "orders")
