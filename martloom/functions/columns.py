"""Column expressions shared by the plans. All are built-in JVM expressions; none is a Python UDF."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The substrings that identify a customer type (the second spelling is the reference's own).
CUSTOMER_TYPE_WORDS = ("citizen", "foriegn")


# Fixed value: what a cast to integer accepts, with control characters and blanks around it.
INTEGER_TEXT = r"^[\x00-\x20]*[+-]?[0-9]+[\x00-\x20]*$"
# Fixed value: what a rounding cast accepts besides, a fraction and an exponent.
NUMBER_TEXT = r"^[\x00-\x20]*[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?[\x00-\x20]*$"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def is_blank(value: Column | str) -> Column:
    text = _col(value)
    return text.isNull() | (F.trim(text) == "")


def has_text(value: Column | str) -> Column:
    text = _col(value)
    return text.isNotNull() & (F.trim(text) != "")


def int_or_null(value: Column | str, rounding: bool = False) -> Column:
    """Text to integer, null where it is not one. ``rounding`` also takes decimal and exponent text, rounded."""
    text = _col(value)
    # A failed cast is an exception inside the engine, caught and paid for per row; the pattern keeps
    # everything but overflows away from it.
    whole = F.when(text.rlike(INTEGER_TEXT), text.try_cast("int"))
    if not rounding:
        return whole
    # Only the rare text that is a number, but no integer, pays for a decimal.
    return whole.when(text.rlike(NUMBER_TEXT), F.round(text.try_cast("decimal(38,10)"), 0).try_cast("int"))


def date_or_null(value: Column | str) -> Column:
    return _col(value).try_cast("date")


def names_customer_type(value: Column | str) -> Column:
    """True when the lower-cased text contains one of the customer type words."""
    lowered = F.lower(_col(value))
    return any_of(lowered.contains(word) for word in CUSTOMER_TYPE_WORDS)


def is_customer_type(value: Column | str) -> Column:
    """The wildcard-free form of the same filter: the text is exactly one of the words."""
    return _col(value).isin(*CUSTOMER_TYPE_WORDS)


def as_object(columns: Iterable[str], prefix: str = "") -> Column:
    """JSON object of the columns; null members are left out."""
    return F.to_json(F.struct(*[F.col(prefix + name).alias(name) for name in columns]))


def differs(left: Column | str, right: Column | str) -> Column:
    """Null-safe inequality: never null, and null differs from every value but null."""
    return ~_col(left).eqNullSafe(_col(right))


def date_text(value: Column | str) -> Column:
    """Date or timestamp as yyyy-MM-dd. A zone-free timestamp does not pass through the session time zone."""
    return _col(value).cast("date").cast("string")


def day_before(value: Column | str) -> Column:
    return F.date_sub(_col(value).cast("date"), 1)


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Difference in whole-second boundaries crossed, so 0.9 s to 2.1 s counts 2."""
    return _whole_seconds(_col(end)) - _whole_seconds(_col(start))


def _whole_seconds(value: Column) -> Column:
    # Built from calendar fields, so a zone-free timestamp never passes through the session time zone.
    days = F.unix_date(value.cast("date")).cast("bigint")
    return days * 86400 + F.hour(value) * 3600 + F.minute(value) * 60 + F.second(value)


def batch_id_of(moment: Column | str) -> Column:
    """BATCH_ and the fourteen digits of the moment, taken from its text so that no time zone comes in."""
    digits = F.regexp_replace(F.substring(_col(moment).cast("string"), 1, 19), "[^0-9]", "")
    return F.concat(F.lit("BATCH_"), digits)


def not_older_than(moment: Column | str, run_ts: datetime, days: int) -> Column:
    """True from ``days`` days before the run on. The bound is a literal, so scans can use it."""
    bound = F.lit(run_ts.isoformat(sep=" ")).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(days)} DAYS")
    return _col(moment) >= bound


def percent(part: Column, whole: Column) -> Column:
    """Percentage rounded half-up to two places, in decimal arithmetic."""
    return F.round(part.cast("decimal(20,0)") * F.lit("100.0").cast("decimal(4,1)") / whole.cast("decimal(20,0)"), 2)


def compare_with_nulls(value: Column | str, operator: str, bound, nulls: str = "first") -> Column:
    """A comparison in which null is a value: below all others (``first``) or above them (``last``)."""
    if nulls not in ("first", "last"):
        raise ValueError("nulls is 'first' or 'last'")
    column = _col(value)
    tests = {
        "<": (column < bound, nulls == "first"),
        "<=": (column <= bound, nulls == "first"),
        ">": (column > bound, nulls == "last"),
        ">=": (column >= bound, nulls == "last"),
        "=": (column == bound, False),
        "<>": (column != bound, True),
    }
    outcome, for_null = tests[operator]
    return F.coalesce(outcome, F.lit(for_null))


def with_default(value: Column | str, default) -> Column:
    return F.coalesce(_col(value), default if isinstance(default, Column) else F.lit(default))


def fold_case(value: Column | str) -> Column:
    return F.lower(_col(value))


def collated(value: Column | str, collation: str) -> Column:
    """Text that compares, groups and sorts by a collation such as UTF8_LCASE, UNICODE_CI or de."""
    return F.collate(_col(value), collation)


def sort_key(
    name: str, descending: bool = False, nulls: str = "first", ignore_case: bool = False, collation: str | None = None
) -> Column:
    column = fold_case(name) if ignore_case else F.col(name)
    if collation:
        column = collated(column, collation)
    if descending:
        return column.desc_nulls_first() if nulls == "first" else column.desc_nulls_last()
    return column.asc_nulls_first() if nulls == "first" else column.asc_nulls_last()
