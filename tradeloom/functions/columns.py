"""Small expressions the plans are written with."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F
from pyspark.sql import types as T

from tradeloom.schemas import DISCOUNT, MONEY

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text -----------------------------------------------------------------------------

def clean_email(c: ColumnOrName) -> Column:
    return F.lower(F.trim(_col(c)))


def clean_label(c: ColumnOrName) -> Column:
    return F.trim(_col(c))


def format_key(prefix: str, c: ColumnOrName, width: int) -> Column:
    """``prefix`` followed by the number padded with zeros; longer numbers stay whole."""
    digits = _col(c).cast("string")
    return F.concat(F.lit(prefix), F.when(F.length(digits) >= width, digits)
                    .otherwise(F.lpad(digits, width, "0")))


# --- typing: a value that doesn't parse becomes null, also in ANSI mode ------------------

def as_money(c: ColumnOrName) -> Column:
    return _col(c).try_cast(MONEY)


def as_discount(c: ColumnOrName) -> Column:
    return _col(c).try_cast(DISCOUNT)


def as_int(c: ColumnOrName) -> Column:
    return _col(c).try_cast(T.IntegerType())


def as_timestamp(c: ColumnOrName) -> Column:
    return _col(c).try_cast(T.TimestampType())


def as_date(c: ColumnOrName) -> Column:
    return _col(c).try_cast(T.DateType())


# --- numbers and times ------------------------------------------------------------------

def net_amount(quantity: ColumnOrName, unit_price: ColumnOrName, discount: ColumnOrName) -> Column:
    """quantity x price x (1 - discount), rounded half up to cents, exact in decimal; null beyond the money type."""
    kept = F.lit(1).cast(DISCOUNT) - _col(discount).cast(DISCOUNT)
    gross = _col(quantity).cast(T.DecimalType(10, 0)) * _col(unit_price).cast(MONEY)
    return F.round(gross * kept, 2).try_cast(MONEY)


def seconds_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole epoch seconds of ``end`` minus those of ``start``."""
    return _col(end).cast("long") - _col(start).cast("long")


def repeatable_draw(seed: int, *ids: ColumnOrName) -> Column:
    """A number in [0, 1) that depends on the ids only, so a retried task draws it again."""
    buckets = 1 << 30
    return F.pmod(F.xxhash64(*[_col(c) for c in ids], F.lit(seed)), F.lit(buckets)) / F.lit(buckets)


def portable_draw(seed: int, *ids: ColumnOrName) -> Column:
    """Like :func:`repeatable_draw`, from md5, so that other engines draw the same number."""
    text = F.concat_ws(":", F.lit(str(seed)), *[_col(c).cast("string") for c in ids])
    return F.conv(F.substr(F.md5(text.cast("binary")), F.lit(1), F.lit(8)), 16, 10).cast("double") / F.lit(float(1 << 32))


# --- choosing labels -------------------------------------------------------------------

def tier(c: ColumnOrName, steps: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """The label of the first step whose threshold the value reaches; steps go downwards."""
    value = _col(c)
    chain = F.when(value >= steps[0][0], F.lit(steps[0][1]))
    for threshold, label in steps[1:]:
        chain = chain.when(value >= threshold, F.lit(label))
    return chain.otherwise(F.lit(otherwise))


def lookup(mapping: Mapping[str, object], c: ColumnOrName) -> Column:
    """The mapped value, null for a key that is not in the mapping."""
    flat = [F.lit(x) for pair in mapping.items() for x in pair]
    return F.try_element_at(F.create_map(*flat), _col(c))


def label_at(labels: Sequence[str], rank: ColumnOrName, fallback: str = "Segment") -> Column:
    """The label of a rank counted from 1; ranks beyond the list become "Segment <rank>"."""
    position = _col(rank)
    listed = F.get(F.array(*[F.lit(x) for x in labels]), (position - 1).cast("int"))
    return F.coalesce(listed, F.concat_ws(" ", F.lit(fallback), position.cast("string")))


def rate(condition: Column) -> Column:
    """Share of rows that meet the condition; a null condition counts as not met."""
    return F.avg(F.when(condition, F.lit(1.0)).otherwise(F.lit(0.0)))
