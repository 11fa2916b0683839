"""Number and date expressions."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Double, or NULL where the text is not a number."""
    return c.try_cast("double")


def to_ts(c: Column, formats: Iterable[str]) -> Column:
    """First format that parses; NULL where none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def abs_value(c: Column) -> Column:
    return F.abs(c)


def round2(c: Column) -> Column:
    return F.round(c, 2)


def clip(c: Column, lo: float, hi: float) -> Column:
    """Bound to [lo, hi]; NULL stays NULL."""
    return F.when(c < lo, F.lit(float(lo))).when(c > hi, F.lit(float(hi))).otherwise(c)


def fill(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def days_between(a: Column, b: Column) -> Column:
    """Whole elapsed days from ``a`` to ``b``."""
    return F.timestamp_diff("DAY", a, b)


def as_of_literal(as_of: str | None) -> Column:
    """The moment "future" is measured from; the clock only when none is given."""
    return F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def is_future(c: Column, as_of: str | None) -> Column:
    return c > as_of_literal(as_of)


def holds(predicate: Column) -> Column:
    """Predicate with NULL counted as "no"."""
    return F.coalesce(predicate, F.lit(False))


def clean_ratio(a: Column, b: Column) -> Column:
    """Quotient, NULL where the divisor is zero."""
    return F.try_divide(a, b)
