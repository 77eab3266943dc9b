import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tradeloom.functions import columns as C
from tradeloom.plans import employees, rfm
from tradeloom.plans.sessions import funnel_events


def one(spark, expression, **values):
    df = spark.range(1)
    for name, value in values.items():
        df = df.withColumn(name, F.lit(value))
    return df.select(expression.alias("x")).first()[0]


@pytest.mark.parametrize("quantity, price, discount, expected", [
    (3, "19.99", "0.15", "50.97"), (1, "10.05", "0.50", "5.03"), (2, "0.01", "0", "0.02")])
def test_net_amount_rounds_half_up_in_decimal(spark, quantity, price, discount, expected):
    got = one(spark, C.net_amount(F.lit(quantity), F.lit(price).cast("decimal(18,2)"), F.lit(discount)))
    assert got == Decimal(expected)


@pytest.mark.parametrize("convert, text", [
    (C.as_int, "x"), (C.as_money, "12,5"), (C.as_timestamp, "yesterday"), (C.as_date, "2024-02-30"), (C.as_discount, "")])
def test_bad_text_becomes_null_and_does_not_raise(spark, convert, text):
    assert one(spark, convert("t"), t=text) is None


def test_good_text_is_typed(spark):
    assert one(spark, C.as_int("t"), t=" 7 ") == 7
    assert one(spark, C.as_money("t"), t="12.345") == Decimal("12.35")
    assert str(one(spark, C.as_date("t"), t="2024-02-29")) == "2024-02-29"


def test_format_key_pads_and_never_cuts(spark):
    assert one(spark, C.format_key("USR", F.lit(42), 8)) == "USR00000042"
    assert one(spark, C.format_key("K", F.lit(12345), 3)) == "K12345"


def test_clean_email(spark):
    assert one(spark, C.clean_email("e"), e="  Ann@X.COM ") == "ann@x.com"


def test_tier_boundaries(spark):
    got = [one(spark, C.tier(F.lit(v), employees.SALARY_GRADES, employees.LOWEST_GRADE))
           for v in (85_000, 84_999, 70_000, 69_999)]
    assert got == ["Senior", "Mid", "Mid", "Junior"]
    letters = [one(spark, C.tier(F.lit(v), employees.LETTER_GRADES, employees.LOWEST_LETTER))
               for v in (80_000, 65_000, 64_999)]
    assert letters == ["A", "B", "C"]
    totals = [one(spark, C.tier(F.lit(v), rfm.SEGMENTS, rfm.LOWEST_SEGMENT)) for v in (15, 13, 12, 10, 9, 7, 6, 5, 4)]
    assert totals == ["Champions", "Champions", "Loyal Customers", "Loyal Customers", "Potential Loyalists",
                      "Potential Loyalists", "At Risk", "At Risk", "Lost / Hibernating"]


def test_lookup_gives_null_for_an_unknown_key(spark):
    assert one(spark, C.lookup({"a": 1}, "k"), k="a") == 1
    assert one(spark, C.lookup({"a": 1}, "k"), k="z") is None


def test_label_at_has_a_fallback_beyond_the_list(spark):
    labels = ["one", "two"]
    assert [one(spark, C.label_at(labels, F.lit(r))) for r in (1, 2, 3)] == ["one", "two", "Segment 3"]


def test_seconds_between_floors_to_whole_seconds(spark):
    start, end = (F.lit(t).cast("timestamp") for t in ("2024-01-01 10:00:00.9", "2024-01-01 10:06:00.1"))
    assert one(spark, C.seconds_between(start, end)) == 360


def test_repeatable_draw_depends_on_the_id_only(spark):
    ids = spark.range(0, 10_000)
    drawn = ids.select("id", C.repeatable_draw(1, "id").alias("x"))
    again = ids.repartition(5).select("id", C.repeatable_draw(1, "id").alias("x"))
    assert drawn.exceptAll(again).isEmpty()
    low, high, mean = drawn.agg(F.min("x"), F.max("x"), F.avg("x")).first()
    assert 0 <= low and high < 1 and abs(mean - 0.5) < 0.02
    other = drawn.join(ids.select("id", C.repeatable_draw(2, "id").alias("y")), "id")
    assert other.filter("x = y").count() < 10


def test_rate_counts_null_as_not_met(spark):
    df = spark.createDataFrame([("f",), ("s",), (None,), ("f",)], "s string")
    assert df.agg(C.rate(F.col("s") == "f")).first()[0] == 0.5


def test_funnel_events_skip_stages_not_reached(spark, rows):
    wide = spark.createDataFrame([("s1", 1, 2, 3, None), ("s2", 5, None, None, None)],
                                 "session_id string, a int, b int, c int, d int")
    got = funnel_events(wide, {"view": "a", "add_to_cart": "b", "checkout_start": "c", "purchase": "d"}, ["session_id"])
    assert rows(got) == [("s1", "add_to_cart", 2), ("s1", "checkout_start", 3), ("s1", "view", 1), ("s2", "view", 5)]


def test_portable_draw_is_even_and_repeatable(spark):
    ids = spark.range(4_000)
    drawn = {r.id: r.x for r in ids.select("id", C.portable_draw(3, "id").alias("x")).collect()}
    assert {r.id: r.x for r in ids.repartition(5).select("id", C.portable_draw(3, "id").alias("x")).collect()} == drawn
    assert all(0 <= x < 1 for x in drawn.values()) and 320 < sum(x < 0.1 for x in drawn.values()) < 480
    assert drawn[5] == int(hashlib.md5(b"3:5").hexdigest()[:8], 16) / 2**32
