"""Keyed deduplication with a total order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.operators.skew import _split, attach, hashable
from burnish.session import materialise


def _first(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    # The "= 1" filter on row_number lets Spark cut every map task down to one row
    # per key before the shuffle (WindowGroupLimit), so a hot key stays small.
    window = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_rn", F.row_number().over(window)).filter(F.col("_rn") == 1).drop("_rn")
    )


def _sortable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if "map<" not in f.dataType.simpleString() and not isinstance(f.dataType, T.VariantType)]


def total_order(df: DataFrame, order_by: list) -> list[Column]:
    """``order_by`` carried on over the other columns: rows that still tie are exact copies."""
    given = [F.col(f"`{c}`") if isinstance(c, str) else c for c in order_by]
    return given + [F.col(f"`{c}`") for c in _sortable(df) if c not in [x for x in order_by if isinstance(x, str)]]


def dedupe_first(df: DataFrame, keys: list[str], order_by: list) -> DataFrame:
    """Keep the first row per key; NULL keys form one group like any other value."""
    return _first(df, keys, total_order(df, order_by))


def dedupe_latest(df: DataFrame, keys: list[str], date: str, order_by: list) -> DataFrame:
    """Keep the row with the latest ``date`` per key; ties go to the first in order."""
    return _first(df, keys, [F.col(date).desc_nulls_last(), *total_order(df, order_by)])


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once (NULL like any other), with their rows ``_n``; stored."""
    counted = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("_n"))
    return materialise(counted.filter("_n > 1"), "repeated")


def dedupe_rest(df: DataFrame, keys: list[str], order_by: list, repeated: DataFrame) -> DataFrame:
    """``dedupe_first`` for a frame that is read several times: ``repeated`` are its repeated keys.

    Rows whose key is sure to occur once stay where they are; only the others are ordered, and the
    first of them stored.  The fewer keys repeat, the less is sorted, shuffled and written; if all do,
    it is all rows once.  Keys that cannot be told apart by a hash are ordered and stored as a whole.
    """
    if repeated.isEmpty():
        return df
    if not hashable(df, keys):
        return materialise(dedupe_first(df, keys, order_by), "kept")
    shared, alone = _split(df, repeated, keys)
    return alone.unionByName(materialise(dedupe_first(shared, keys, order_by), "kept"))


def drop_null_key(df: DataFrame, key: str) -> DataFrame:
    return df.filter(F.col(key).isNotNull())


def duplicate_rows(df: DataFrame, keys: list[str], order_by: list[str]) -> DataFrame:
    """The rows ``dedupe_first`` removes: all but the first per key.

    The first position per key is a map-side combined minimum joined back, so no
    key's rows are gathered in one task.  Rows at the first position are exact copies of
    the kept one; they are counted, and all but one of them listed.
    """
    position = F.struct(*[c.alias(f"p{i}") for i, c in enumerate(total_order(df, order_by))])
    safe = [F.coalesce(F.col(k).cast("string"), F.lit("\u0000")).alias(f"_k{i}") for i, k in enumerate(keys)]
    names = [f"_k{i}" for i in range(len(keys))]
    keyed = df.select("*", *safe)
    firsts = keyed.groupBy(*names).agg(F.min(position).alias("_first"), F.count(F.lit(1)).alias("_n"))
    firsts = firsts.filter(F.col("_n") > 1).drop("_n")
    shared = attach(keyed, firsts, names).filter(F.col("_first").isNotNull())
    later = shared.filter(position > F.col("_first")).select(*df.columns)
    plain = _sortable(df)
    copies = shared.filter(position.eqNullSafe(F.col("_first")))
    copies = copies.groupBy(*[F.col(f"`{c}`") for c in plain]).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(F.col(f"`{c}`")).alias(c) for c in df.columns if c not in plain]
    )
    copies = copies.filter(F.col("_n") > 1).withColumn("_copy", F.explode(F.sequence(F.lit(2), F.col("_n"))))
    return later.unionByName(copies.select(*df.columns))


def key_multiplicity(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows, distinct keys, rows sharing a key, extra copies."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_rows"),
        F.count(F.lit(1)).alias("distinct_keys"),
        F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("shared_rows"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_copies"),
    )


def rows_beside_total(df: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Group total beside each row, as a pre-aggregated sum joined back by key."""
    totals = df.groupBy(key).agg(F.sum(value).alias(name))
    return attach(df, totals, [key])
