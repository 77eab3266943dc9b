"""Raw tables to trusted ones: one row per key, typed, valid, pointing at known rows.

Every function returns the table with a ``_reject_reasons`` column; ``quality.accepted`` and
``quality.rejected`` take the two sides, ``quality.land_split`` writes both in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

from tradeloom.functions.columns import (as_date, as_discount, as_int, as_money, as_timestamp, clean_email,
                                         clean_label, net_amount)
from tradeloom.operators.dedup import dedup_latest
from tradeloom.operators.joins import input_bytes
from tradeloom.operators.ordering import sort_names
from tradeloom.operators.quality import REASONS, tag_rows, tag_unknown
from tradeloom.sources.files import CORRUPT

NEWEST = ("_ingested_at desc",)
MALFORMED = "malformed"  # the reason of lines that don't fit their file's columns
_ALONE = "_alone"
PARTS, PART_BYTES = 4, 16 * 1024 * 1024  # a table is cleaned in so many parts at most; file bytes of a part of smaller tables
ORIGIN = (CORRUPT, "_source_file")  # what a rejected row needs to be looked up: its raw text and its file


def _origin(raw: DataFrame) -> list[str]:
    return [c for c in ORIGIN if c in raw.columns]


def one_per_key(raw: DataFrame, keys: Sequence[str], order: Sequence[str] = NEWEST,
                tiebreak: Sequence[str] | None = None) -> DataFrame:
    """The latest copy of each key; without a tie-break all other columns settle ties.

    Rows that lack a key, or whose line could not be read, are copies of nothing and replace nothing: all of them stay, for
    the checks to reject. A number of its own makes each of them a group of the same window, so the input is read once.
    """
    used = {*sort_names(order), *keys}
    alone = raw.withColumn(_ALONE, F.when(~_keyed(raw, keys), F.monotonically_increasing_id()))
    return dedup_latest(alone, [*keys, _ALONE], order, tiebreak or [c for c in raw.columns if c not in used]).drop(_ALONE)


def by_key(raw: DataFrame, keys: Sequence[str]) -> Iterator[DataFrame]:
    """The table in parts that hold all rows of their keys, to be cleaned one after the other.

    Cleaning shuffles whole rows up to three times, and all of that lies on disk until a write is done; in parts it is a
    quarter, for reading the table four times. Rows that are copies of nothing are dealt by all their values. The table must
    give the same rows whenever it is read.
    """
    parts = max(1, min(PARTS, -(-input_bytes(raw) // PART_BYTES)))
    dealt = F.when(_keyed(raw, keys), F.xxhash64(*keys)).otherwise(F.xxhash64(*raw.columns))
    for part in range(parts):
        yield raw if parts == 1 else raw.filter(F.pmod(dealt, F.lit(parts)) == part)


def _keyed(raw: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(and_, [F.col(key).isNotNull() for key in keys], readable(raw))


def readable(raw: DataFrame) -> Column:
    """Whether the row's line was read whole; files are the only source of lines that are not."""
    return F.col(CORRUPT).isNull() if CORRUPT in raw.columns else F.lit(True)


def tag_known(tagged: DataFrame, known_users: DataFrame, known_products: DataFrame) -> DataFrame:
    """Check the users and products that facts point at, anew if that was done before."""
    if REASONS in tagged.columns:
        tagged = tagged.withColumn(REASONS, F.filter(REASONS, lambda reason: ~reason.startswith("unknown_")))
    return tag_unknown(tag_unknown(tagged, known_users, "user_id"), known_products, "product_id")


def users(raw: DataFrame, **dedup) -> DataFrame:
    typed = one_per_key(raw, ["user_id"], **dedup).withColumns(
        {"email": clean_email("email"), "signup_date": as_date("signup_date")})
    return tag_rows(typed, {MALFORMED: readable(raw), "user_id": F.col("user_id").isNotNull()}).select(
        "user_id", "name", "email", "city", "state", "signup_date", "preferred_device", *_origin(raw), REASONS)


def products(raw: DataFrame, **dedup) -> DataFrame:
    typed = one_per_key(raw, ["product_id"], **dedup).withColumns(
        {"list_price": as_money("list_price"), "category": clean_label("category")})
    return tag_rows(typed, {MALFORMED: readable(raw), "product_id": F.col("product_id").isNotNull(),
                            "list_price": F.col("list_price").isNotNull()}).select(
        "product_id", "product_name", "category", "sub_category", "brand", "list_price", *_origin(raw), REASONS)


def type_orders(raw: DataFrame) -> DataFrame:
    return raw.withColumns({"quantity": as_int("quantity"), "unit_price": as_money("unit_price"),
                            "discount_pct": as_discount("discount_pct"),
                            "order_timestamp": as_timestamp("order_timestamp"),
                            "return_timestamp": as_timestamp("return_timestamp")})


def orders(raw: DataFrame, known_users: DataFrame, known_products: DataFrame,
           keys: Sequence[str] = ("order_id",), **dedup) -> DataFrame:
    typed = type_orders(one_per_key(raw, keys, **dedup))
    counted = F.col("quantity").isNotNull() & F.col("unit_price").isNotNull() & F.col("discount_pct").isNotNull()
    checked = tag_rows(typed.withColumn("net_amount", net_amount("quantity", "unit_price", "discount_pct")), {
        MALFORMED: readable(raw), **{key: F.col(key).isNotNull() for key in keys}, "quantity": F.col("quantity") > 0,
        "unit_price": F.col("unit_price") > 0, "net_amount": ~counted | F.col("net_amount").isNotNull()})
    return tag_known(checked, known_users, known_products)


def clickstream(raw: DataFrame, known_users: DataFrame, known_products: DataFrame, **dedup) -> DataFrame:
    typed = one_per_key(raw, ["event_id"], **dedup).withColumn(
        "event_timestamp", as_timestamp("event_timestamp"))
    checked = tag_rows(typed, {MALFORMED: readable(raw),
                               **{c: F.col(c).isNotNull() for c in ("event_id", "session_id", "user_id", "event_timestamp")}})
    return tag_known(checked, known_users, known_products)
