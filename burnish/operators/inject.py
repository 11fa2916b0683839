"""Deterministic defect injection, so cleaning can be regression-tested at any size.

A row is hit by arithmetic on its key: the same rows on every run and every cluster, with
no random state.  Any rate is met within one key in every run of consecutive keys.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.operators.skew import attach
from burnish.session import materialise

PARTS = 1_000_000  # rates are whole millionths
BLOCK = 1_000  # neighbouring keys among which a key is copied


def number_of(df: DataFrame, key: str) -> Column:
    """The key as a number; text keys are hashed."""
    return F.col(key).cast("bigint") if isinstance(df.schema[key].dataType, T.IntegralType) else F.xxhash64(key)


def hit(df: DataFrame, key: str, every: int, offset: int = 0) -> Column:
    """True for one key in ``every``."""
    return F.pmod(number_of(df, key), F.lit(every)) == F.lit(offset % every)


def hit_share(df: DataFrame, key: str, pct: float, offset: int = 0) -> Column:
    """True for ``pct`` percent of the keys, evenly spaced."""
    share = round(pct * PARTS / 100)
    return F.pmod(F.pmod(number_of(df, key) - F.lit(offset), F.lit(PARTS)) * F.lit(share), F.lit(PARTS)) < F.lit(share)


def inject_nulls(df: DataFrame, column: str, key: str, pct: float, offset: int = 0) -> DataFrame:
    return _set(df, column, hit_share(df, key, pct, offset), F.lit(None))


def inject_negatives(df: DataFrame, column: str, key: str, pct: float, offset: int = 0) -> DataFrame:
    return _set(df, column, hit_share(df, key, pct, offset), -F.abs(F.col(column)))


def inject_dup_keys(df: DataFrame, column: str, key: str, pct: float) -> DataFrame:
    """Give ``pct`` percent of the rows of each block of keys the value of the last row before them that keeps its own.

    Rows are ordered by ``key`` inside a block, so sparse and text keys are copied as well
    as dense ones; the range of the numbers, or of the hash values, is cut into equal
    blocks that hold about ``BLOCK`` rows each.  A block of more than twice as many is cut
    again between its own least and largest key, one of a single key by the hash of
    ``column``.  Rows that agree in both would only take each other's value: they keep theirs.
    """
    placed, even = _blocks(df, column, key)
    by = Window.partitionBy("_block").orderBy(key, column)
    share = round(pct * PARTS / 100)
    rank = F.row_number().over(by).cast("bigint") - 1
    taken = F.floor((rank + 1) * share / PARTS) > F.floor(rank * share / PARTS)
    placed = placed.withColumn("_taken", taken)
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    copied = F.coalesce(F.last(F.when(~F.col("_taken"), F.col(column)), ignorenulls=True).over(upto), F.col(column))
    copied = placed.withColumn("_copied", copied).drop("_block", "_taken", column).withColumnRenamed("_copied", column).select(*df.columns)
    return copied if even is None else copied.unionByName(even)


def _blocks(df: DataFrame, column: str, key: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows with their ``_block``, and those of one key and value that would fill a block alone.

    Each round reads the table once, counts rows per block map-side and stores only the blocks
    that are still too large, which are joined back by size.  A round at least halves their
    ranges; a lone outlier takes one round more than even keys.
    """
    wide = T.DecimalType(38, 0)
    number = number_of(df, key).cast(wide)
    size = df.agg(F.count(F.lit(1)).alias("n"), F.min(number).alias("lo"), F.max(number).alias("hi")).first()
    least = size.lo or 0
    width = max(1, BLOCK * ((size.hi or 0) - least + 1) // max(1, size.n))
    first = F.floor((number - F.lit(least).cast(wide)) / F.lit(width).cast(wide)).cast("bigint")
    placed = df.withColumn("_block", F.array(first))
    value = F.xxhash64(column).cast(wide)
    alone = None
    by_value = False
    while True:
        own = number_of(placed, key).cast(wide) if not by_value else value
        blocks = placed.groupBy("_block").agg(F.count(F.lit(1)).alias("_n"), F.min(own).alias("_lo"), F.max(own).alias("_hi"))
        large = materialise(blocks.filter(F.col("_n") > 2 * BLOCK), "large-blocks")
        single = large.filter(F.col("_lo").eqNullSafe(F.col("_hi")))
        if by_value and not single.isEmpty():
            marked = attach(placed, single.select("_block", F.lit(True).alias("_single")), ["_block"])
            even = marked.filter("_single").select(*df.columns)
            alone = even if alone is None else alone.unionByName(even)
            placed = marked.filter("_single IS NULL").drop("_single")
        ranged = large.filter(~F.col("_lo").eqNullSafe(F.col("_hi")))
        if ranged.isEmpty():
            if by_value or single.isEmpty():
                return placed, alone
            by_value = True
            continue
        step = F.greatest(F.lit(1), F.floor(F.lit(BLOCK) * (F.col("_hi") - F.col("_lo") + 1) / F.col("_n")))
        cuts = ranged.select("_block", "_lo", F.least(step, F.ceil((F.col("_hi") - F.col("_lo") + 1) / 2)).cast(wide).alias("_step"))
        cut = F.when(F.col("_lo").isNotNull(), F.floor((own - F.col("_lo")) / F.col("_step")).cast("bigint"))
        placed = attach(placed, cuts, ["_block"]).withColumn("_block", F.when(cut.isNotNull(), F.concat("_block", F.array(cut))).otherwise(F.col("_block"))).drop("_lo", "_step")


def inject_range(df: DataFrame, column: str, key: str, values: list[float], pct: float) -> DataFrame:
    """Out-of-range values, taken in turn from ``values``."""
    share = round(pct * PARTS / 100)
    turn = F.pmod(F.floor(F.pmod(number_of(df, key), F.lit(PARTS * len(values))) * F.lit(share) / PARTS), F.lit(len(values)))
    value = F.get(F.array(*[F.lit(v) for v in values]), turn.cast("int"))
    return df.withColumn(column, F.when(hit_share(df, key, pct), value).otherwise(F.col(column)))


def inject_reversed(df: DataFrame, start: str, end: str, key: str, pct: float, days: int = 7) -> DataFrame:
    """Put ``end`` ``days`` before ``start``."""
    early = F.col(start) - F.make_dt_interval(F.lit(days))
    return _set(df, end, hit_share(df, key, pct), early)


def inject_dates(df: DataFrame, column: str, key: str, value: str, pct: float) -> DataFrame:
    return _set(df, column, hit_share(df, key, pct), F.lit(value).cast(df.schema[column].dataType))


def inject_variants(df: DataFrame, column: str, key: str, variants: list[str]) -> DataFrame:
    """Spread the rows over spellings of one value."""
    at = F.pmod(number_of(df, key), F.lit(len(variants)))
    choice = F.get(F.array(*[F.lit(v) for v in variants]), at.cast("int"))
    return df.withColumn(column, choice)


def inject_bad_text(df: DataFrame, column: str, key: str, patterns: list[str], every: int) -> DataFrame:
    """Malformed text: ``{n}`` in a pattern becomes the key; the pattern is its residue."""
    return df.withColumn(
        column,
        reduce(
            lambda out, i: F.when(
                hit(df, key, every, i),
                F.replace(F.lit(patterns[i]), F.lit("{n}"), F.col(key).cast("string")),
            ).otherwise(out),
            range(len(patterns)),
            F.col(column),
        ),
    )


def inject_padding(df: DataFrame, column: str, key: str, every: int) -> DataFrame:
    return _set(df, column, hit(df, key, every), F.concat(F.lit("  "), F.col(column), F.lit("  ")))


def inject_orphans(df: DataFrame, column: str, key: str, pct: float, shift: int = 1_000_000_000) -> DataFrame:
    return _set(df, column, hit_share(df, key, pct), F.col(column) + F.lit(shift))


def inject_identity(df: DataFrame, column: str, key: str, factor: float, pct: float) -> DataFrame:
    """Break an arithmetic identity by scaling one side."""
    return _set(df, column, hit_share(df, key, pct), F.col(column) * F.lit(factor))


def inject_imbalance(df: DataFrame, column: str, group: str, key: str, pct: float, factor: float = 1.1) -> DataFrame:
    """Scale one side of the rows hit inside groups hit, leaving those groups unbalanced."""
    return _set(df, column, hit_share(df, group, pct) & hit(df, key, 2), F.col(column) * F.lit(factor))


def inject_text_noise(df: DataFrame, column: str, key: str, kind: str, every: int, other: str | None = None) -> DataFrame:
    """``html`` wraps, ``encoding`` adds a replacement character, ``swap`` takes another
    column's text, ``float`` adds noise behind the cents."""
    c = F.col(column)
    noisy = {
        "html": F.concat(F.lit("<p><b>"), c.cast("string"), F.lit("</b></p><br/>")),
        "encoding": F.concat(c.cast("string"), F.lit("�")),
        "swap": F.col(other) if other else c,
        "float": c.try_cast("double") + F.lit(1e-7),
    }[kind]
    return _set(df, column, hit(df, key, every), noisy)


def inject_outliers(df: DataFrame, column: str, key: str, factor: float, pct: float) -> DataFrame:
    return _set(df, column, hit_share(df, key, pct), F.col(column) * F.lit(factor))


def _set(df: DataFrame, column: str, where: Column, value: Column) -> DataFrame:
    return df.withColumn(column, F.when(where, value).otherwise(F.col(column)).cast(df.schema[column].dataType))
