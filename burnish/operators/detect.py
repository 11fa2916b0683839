"""Issue tests: row predicates as Columns, table tests as DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnish.functions import text as X
from burnish.functions.numbers import as_of_literal, days_between, holds
from burnish.operators.dedupe import key_multiplicity
from burnish.operators.skew import is_small
from burnish.plans.rules import Check
from burnish.session import materialise


# Row predicates.  NULL never counts as an issue (except where NULL is the issue).
def null_key(c: Column) -> Column:
    return c.isNull()


def sequence_break(start: Column, end: Column) -> Column:
    return holds(start > end)


def future_date(c: Column, as_of: str | None) -> Column:
    return holds(c > as_of_literal(as_of))


def legacy_date(c: Column, before: str) -> Column:
    return holds(c < F.lit(before).cast("timestamp_ntz"))


def negative(c: Column) -> Column:
    return holds(c < 0)


def out_of_range(c: Column, lo: float | None = None, hi: float | None = None) -> Column:
    tests = ([c < lo] if lo is not None else []) + ([c > hi] if hi is not None else [])
    return holds(reduce(lambda a, b: a | b, tests))


def bad_email(c: Column) -> Column:
    return holds(~X.valid_email(c))


def padded(c: Column) -> Column:
    return holds(X.padded(c))


def orphan_pattern(c: Column, above: int | None = None, text: str | None = None) -> Column:
    """Orphan by rule: identifier suffix above a bound, or a telltale substring."""
    if text is not None:
        return holds(X.has_text(c, text))
    return holds(X.id_suffix(c) > above)


def identity_break(lhs: Column, rhs: Column, tol: float, relative: bool = False) -> Column:
    gap = F.abs(lhs - rhs)
    return holds(gap > (F.abs(rhs) * tol if relative else F.lit(tol)))


def shortfall(lhs: Column, rhs: Column, tol: float = 1e-9) -> Column:
    """``lhs`` falls below ``rhs`` by more than rounding noise."""
    return holds(lhs < rhs * (1 - tol))


def physics_break(power: Column, volts: Column, amps: Column, factor: float = 0.001) -> Column:
    """Power above volts x amps in the power's unit (0.001: kW from W)."""
    return holds(power > volts * amps * F.lit(factor) * (1 + 1e-9))


def conditional_value(c: Column, value, condition: Column) -> Column:
    return holds((c == value) & condition)


def above_band(c: Column, high: Column) -> Column:
    return holds(c > high)


def over_balance(used: Column, left: Column, entitlement: Column | None = None) -> Column:
    return holds(used > (used + left if entitlement is None else entitlement))


def lag_over(a: Column, b: Column, days: int) -> Column:
    return holds(days_between(a, b) > days)


def excess_precision(c: Column, digits: int = 2) -> Column:
    return holds(F.abs(c - F.round(c, digits)) > 1e-9)


def has_markup(c: Column) -> Column:
    return holds(X.has_markup(c))


def bad_encoding(c: Column) -> Column:
    return holds(X.bad_encoding(c))


def invalid_utf8(c: Column) -> Column:
    """For binary columns: bytes that are not valid UTF-8."""
    return holds(~F.is_valid_utf8(c))


def unit_break(a: Column, b: Column, factor: float, tol: float = 0.01) -> Column:
    """``b`` is not ``a`` times the unit factor."""
    return identity_break(b, a * F.lit(factor), tol)


def stale_rate(a: Column, b: Column, rate: Column | float, tol: float = 0.01) -> Column:
    """``b`` is not ``a`` at the given rate."""
    return identity_break(b, a * (rate if isinstance(rate, Column) else F.lit(rate)), tol)


def large_value(c: Column, bound: float) -> Column:
    return holds(c > bound)


# Table tests.
def dup_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    """Extra copies of a key: second and later occurrences."""
    return key_multiplicity(df, keys).select("extra_copies")


def dup_listing(df: DataFrame, keys: list[str], n: int = 10) -> DataFrame:
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")
    return counts.orderBy(F.desc("cnt"), *keys).limit(n)


def orphan_fk(df: DataFrame, column: str, master: DataFrame, key: str) -> DataFrame:
    """Orphan values with their row counts.

    Foreign keys are counted before the anti join, so a hot key moves as one row.
    """
    used = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    known = materialise(master.select(F.col(key).alias(column)).distinct(), "keys")
    if is_small(known):
        known = F.broadcast(known)
    return used.join(known, column, "left_anti")


def mixed_category(df: DataFrame, column: str) -> DataFrame:
    """Canonical values written in more than one way: canonical, variants, rows."""
    raw = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return (
        raw.groupBy(F.upper(X.trim_ws(F.col(column))).alias("canonical"))
        .agg(F.count(F.lit(1)).alias("variants"), F.sum("n").alias("rows"))
        .filter("variants > 1")
    )


def issue_counts(checks: list[Check]) -> list[Column]:
    return [F.count_if(c.predicate()).alias(f"n{i}") for i, c in enumerate(checks)]


def issue_rows(counted: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check from the row that holds its count and ``total_rows``."""
    rows = [
        F.struct(
            F.lit(c.name).alias("issue"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.dimension).alias("dimension"),
            F.lit(c.severity).alias("severity"),
            F.col(f"n{i}").alias("issue_rows"),
            F.round(F.try_divide(F.col(f"n{i}") * 100, F.col("total_rows")), 2).alias("pct"),
        )
        for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def detect_issues(df: DataFrame, checks: list[Check]) -> DataFrame:
    """All row checks in one aggregation, one row per check."""
    present = [c for c in checks if c.column in df.columns]
    return issue_rows(df.agg(F.count(F.lit(1)).alias("total_rows"), *issue_counts(present)), present)


def issue_summary(issues: DataFrame) -> DataFrame:
    """Issues found and rows concerned per severity."""
    return (
        issues.filter("issue_rows > 0")
        .groupBy("severity")
        .agg(F.count(F.lit(1)).alias("issues"), F.sum("issue_rows").alias("issue_rows"))
    )


def affected_rows(df: DataFrame, checks: list[Check]) -> DataFrame:
    """Rows with at least one issue."""
    present = [c for c in checks if c.column in df.columns]
    return df.agg(F.count(F.lit(1)).alias("total_rows"), affected_count(present))


def affected_count(checks: list[Check]) -> Column:
    return F.count_if(reduce(lambda a, b: a | b, [c.predicate() for c in checks])).alias("affected_rows")


def issue_overview(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Issue counts of many tables and layers under one another."""
    pieces = [
        issue_summary(issues).select(F.lit(t).alias("table_name"), F.lit(layer).alias("layer"), "*")
        for (t, layer), issues in tables.items()
    ]
    return reduce(DataFrame.unionByName, pieces)
