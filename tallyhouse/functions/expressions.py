"""Scalar expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date, datetime
from typing import Any

from pyspark.sql import Column, functions as F

from tallyhouse.schemas import AMOUNT_BANDS, MONEY, TOP_AMOUNT_BAND


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day(value: Column | str | date | datetime) -> Column:
    """A DATE literal from text or a Python date; columns pass through."""
    return value if isinstance(value, Column) else F.lit(str(value)[:10]).cast("date")


def instant(value: Column | str | datetime) -> Column:
    """A zone-less timestamp literal; columns pass through."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


# --- predicates -------------------------------------------------------------

def is_present(c: Column | str) -> Column:
    """Neither NULL nor the empty string."""
    c = as_column(c)
    return c.isNotNull() & (c != "")


def in_range(c: Column | str, low: Any, high: Any) -> Column:
    """Half-open: low <= c < high."""
    c = as_column(c)
    return (c >= low) & (c < high)


# --- CASE forms -------------------------------------------------------------

def below_band(c: Column | str, bounds: Sequence[tuple[Any, str]], otherwise: str) -> Column:
    """Label of the first upper bound the value stays below. NULL gets ``otherwise``."""
    c = as_column(c)
    (first, label), *rest = bounds
    chain = F.when(c < first, label)
    for bound, label in rest:
        chain = chain.when(c < bound, label)
    return chain.otherwise(otherwise)


def floor_band(c: Column | str, floors: Sequence[tuple[Any, str]], otherwise: str) -> Column:
    """Label of the first floor the value reaches. NULL gets ``otherwise``."""
    c = as_column(c)
    (first, label), *rest = floors
    chain = F.when(c >= first, label)
    for floor, label in rest:
        chain = chain.when(c >= floor, label)
    return chain.otherwise(otherwise)


def amount_category(c: Column | str, bounds: Sequence[tuple[Any, str]] = AMOUNT_BANDS) -> Column:
    return below_band(c, bounds, TOP_AMOUNT_BAND)


def decode(c: Column | str, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Simple CASE: value -> mapped value, anything else -> default."""
    c = as_column(c)
    pairs = list(mapping.items())
    chain = F.when(c == pairs[0][0], F.lit(pairs[0][1]))
    for key, value in pairs[1:]:
        chain = chain.when(c == key, F.lit(value))
    return chain.otherwise(F.lit(default))


def rank_of(c: Column | str, ordered: Iterable[Any]) -> Column:
    """1-based place of the value in a fixed list; NULL when not listed."""
    return decode(c, {value: place for place, value in enumerate(ordered, 1)})


def status_clean(c: Column | str) -> Column:
    """Only NULL becomes UNKNOWN; blanks are kept."""
    return F.coalesce(as_column(c), F.lit("UNKNOWN"))


# --- money and numbers ------------------------------------------------------

def money(c: Column | str) -> Column:
    return as_column(c).cast(MONEY)


def line_total(price: Column | str, quantity: Column | str, percent: Column | str) -> Column:
    """price * quantity * (1 - percent/100), rounded half up to cents."""
    kept = (F.lit(100).cast("decimal(3,0)") - as_column(percent).cast("decimal(5,2)")) * F.lit(
        "0.01"
    ).cast("decimal(3,2)")
    gross = as_column(price).cast("decimal(12,2)") * as_column(quantity).cast("decimal(6,0)")
    return (gross * kept).cast(MONEY)


def rounded_long(c: Column | str) -> Column:
    """Number to BIGINT rounding halves away from zero (a plain cast would truncate)."""
    return F.round(as_column(c)).cast("bigint")


def to_number(c: Column | str) -> Column:
    """Text to DOUBLE; text that is no number becomes NULL."""
    return as_column(c).try_cast("double")


def to_day(c: Column | str, pattern: str = "yyyy-MM-dd") -> Column:
    """Text to DATE; text that is no date becomes NULL."""
    return F.try_to_date(as_column(c), pattern)


# --- dates ------------------------------------------------------------------

def month_label(c: Column | str) -> Column:
    return F.date_format(as_column(c), "yyyy-MM")


def days_since(c: Column | str, as_of: Column | str | date) -> Column:
    return F.datediff(day(as_of), as_column(c))


def age(c: Column | str, as_of: Column | str | datetime) -> Column:
    """Elapsed day-time interval as text."""
    return (instant(as_of) - as_column(c)).cast("string")


# --- partition transforms ---------------------------------------------------

def year_of(c: Column | str) -> Column:
    return F.year(as_column(c))


def month_of(c: Column | str) -> Column:
    """Year and month as one number, so that months of different years stay apart."""
    c = as_column(c)
    return F.year(c) * 12 + F.month(c) - 1


def bucket_of(c: Column | str, buckets: int) -> Column:
    return F.pmod(F.hash(as_column(c)), F.lit(buckets))


def truncated_text(c: Column | str, width: int) -> Column:
    return F.substring(as_column(c), 1, width)


def truncated_number(c: Column | str, width: int) -> Column:
    c = as_column(c)
    return c - F.pmod(c, F.lit(width))


def month_filter(date_column: str, year: int, month: int, year_column: str, month_column: str) -> Column:
    """One month, stated on the partition columns (pruning) and on the date (row-group skipping)."""
    first = date(year, month, 1)
    after = date(year + month // 12, month % 12 + 1, 1)
    return (
        (F.col(year_column) == year)
        & (F.col(month_column) == month)
        & in_range(date_column, F.lit(first), F.lit(after))
    )


# --- text and nested values -------------------------------------------------

def email_domain(c: Column | str) -> Column:
    """Text after the first @; NULL when there is none."""
    c = as_column(c)
    return F.when(F.instr(c, "@") > 0, F.regexp_extract(c, "@(.*)$", 1))


def spec(column: Column | str, key: str) -> Column:
    return F.try_element_at(as_column(column), F.lit(key))


def has_tag(column: Column | str, tag: str) -> Column:
    return F.array_contains(as_column(column), tag)


def volume(column: str = "dimensions") -> Column:
    return F.col(f"{column}.length") * F.col(f"{column}.width") * F.col(f"{column}.height")
