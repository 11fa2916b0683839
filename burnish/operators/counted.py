"""Exact statistics from counts of values, which add up over parts and batches.

A statistic's input is stored as (value, other, n) rows, one per distinct value, and the
counts of several batches are merged by adding.  Quantiles, modes, means, moments and
regressions then come from the merged rows; none gathers all values in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnish.plans.rules import Stat
from burnish.session import materialise


def value_counts(df: DataFrame, stat: Stat) -> DataFrame:
    """(value, other, n): how often each value (or pair) occurs where the statistic looks."""
    value = F.expr(stat.value)
    if stat.where is not None:
        value = F.when(F.expr(stat.where), value)
    if stat.kind == "quantile":
        value = value.cast("double")
    other = F.lit(None).cast("double") if stat.other is None else F.expr(stat.other).cast("double")
    pairs = df.select(value.alias("value"), other.alias("other")).filter("value IS NOT NULL")
    if stat.other is not None:
        pairs = pairs.filter("other IS NOT NULL")
    return pairs.groupBy("value", "other").agg(F.count(F.lit(1)).alias("n"))


def merge_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy("value", "other").agg(F.sum("n").alias("n"))


def counted_quantile(counts: DataFrame, q: float) -> float | None:
    """Linear-interpolation quantile of counted values.

    Values are dealt into ranges; the sums per range (one number each) tell in which range the
    rank lies, and only that one is ordered.
    """
    dealt = materialise(counts.select("value", "n").repartitionByRange("value").withColumn("part", F.spark_partition_id()), "counted")
    sums = sorted(tuple(r) for r in dealt.groupBy("part").agg(F.sum("n")).collect())
    total = sum(n for _, n in sums)
    if not total:
        return None
    position = q * (total - 1)

    def at(rank: int):
        for part, n in sums:
            if rank < n:
                break
            rank -= n
        # Within one range: the smallest value whose running count passes the rank.
        inside = dealt.filter(F.col("part") == part).groupBy("value").agg(F.sum("n").alias("n"))
        run = inside.selectExpr("value", "sum(n) OVER (ORDER BY value) AS upto")
        return run.filter(F.col("upto") > rank).agg(F.min("value")).first()[0]

    low = at(math.floor(position))
    high = low if position == math.floor(position) else at(math.ceil(position))
    return low + (high - low) * (position - math.floor(position))


def _moments(counts: DataFrame, powers: int) -> tuple:
    n, mean = counts.agg(F.sum("n"), F.sum(F.col("value").cast("double") * F.col("n")) / F.sum("n")).first()
    if not n:
        return (0, None)
    gap = F.col("value").cast("double") - F.lit(mean)
    return (n, mean, *counts.agg(*[F.sum(F.pow(gap, F.lit(p)) * F.col("n")) for p in range(2, powers + 1)]).first())


def _pairs(counts: DataFrame) -> tuple:
    """(n, mean of y, mean of x, Syy, Sxx, Sxy), with y the value and x the other column."""
    y, x, n = F.col("value").cast("double"), F.col("other"), F.col("n")
    total, my, mx = counts.agg(F.sum(n), F.sum(y * n) / F.sum(n), F.sum(x * n) / F.sum(n)).first()
    if not total:
        return (0, None, None, None, None, None)
    dy, dx = y - F.lit(my), x - F.lit(mx)
    return (total, my, mx, *counts.agg(F.sum(dy * dy * n), F.sum(dx * dx * n), F.sum(dx * dy * n)).first())


def counted_stat(counts: DataFrame, stat: Stat):
    """The statistic's value from merged counts, as ``compute_stats`` gives it from rows."""
    if stat.kind == "quantile":
        return counted_quantile(counts, stat.q)
    if stat.kind == "mode":
        return counts.agg(F.min_by("value", F.struct(-F.col("n"), F.col("value")))).first()[0]
    if stat.kind == "mean":
        return counts.agg(F.sum(F.col("value") * F.col("n")) / F.sum("n")).first()[0]
    if stat.kind in ("min", "max"):
        return counts.agg({"value": stat.kind}).first()[0]
    if stat.kind == "sum":
        return counts.agg(F.sum(F.col("value") * F.col("n"))).first()[0]
    if stat.kind == "skewness":
        n, _, *more = _moments(counts, 3)
        if not n:
            return None
        return float("nan") if not more[0] else math.sqrt(n) * more[1] / more[0] ** 1.5
    n, my, mx, syy, sxx, sxy = _pairs(counts)
    if not n or not sxx:
        return None
    if stat.kind == "slope":
        return sxy / sxx
    if stat.kind == "intercept":
        return my - sxy / sxx * mx
    if stat.kind == "corr":
        return None if not syy else sxy / math.sqrt(sxx * syy)
    raise ValueError(f"{stat.name}: no counted form of {stat.kind}")
