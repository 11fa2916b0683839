"""Column profiles as mergeable rows.

One row per column holds exact counts and extremes, an HLL sketch of the distinct values and a
KLL sketch of the numbers.  Rows of parts, days or batches are merged by adding and uniting
them, so the profile of a table is made from stored rows and its data are not read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LG_K = 12  # HLL: standard error 1.04 / 2 ** (LG_K / 2), about 1.6 percent
KLL_K = 400  # KLL: rank error about 0.7 percent
SCHEMA = (
    "column_name string, data_type string, total_rows bigint, null_count bigint, min_value double, max_value double, "
    "text_chars bigint, distinct_sketch binary, number_sketch binary"
)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _sketched(value: Column, kind: T.DataType) -> Column:
    """What the distinct sketch takes: whole numbers and texts as they are, all else as text."""
    if isinstance(kind, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        return value.cast("bigint")
    return value if isinstance(kind, T.BinaryType) else value.cast("string")


def column_sketches(df: DataFrame, cols: list[str] | None = None, by: list[str] = ()) -> DataFrame:
    """One row per column (and per group of ``by``), all in one aggregation over ``df``."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cols = [c for c in (cols or df.columns) if c not in by]
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, c in enumerate(cols):
        value = F.col(_quoted(c))
        number = value.cast("double") if isinstance(kinds[c], T.NumericType) else F.lit(None).cast("double")
        aggs += [
            F.count(value).alias(f"_n{i}"),
            F.hll_sketch_agg(_sketched(value, kinds[c]), F.lit(LG_K)).alias(f"_d{i}"),
            F.min(number).alias(f"_lo{i}"),
            F.max(number).alias(f"_hi{i}"),
            F.sum(F.length(value).cast("bigint") if isinstance(kinds[c], T.StringType) else F.lit(None).cast("bigint")).alias(f"_c{i}"),
        ]
        if isinstance(kinds[c], T.NumericType):
            aggs.append(F.kll_sketch_agg_double(number, F.lit(KLL_K)).alias(f"_k{i}"))
    keys = [F.col(_quoted(b)) for b in by]
    row = df.groupBy(*keys).agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(kinds[c].simpleString()).alias("data_type"),
            F.col("_rows").alias("total_rows"),
            (F.col("_rows") - F.col(f"_n{i}")).alias("null_count"),
            F.col(f"_lo{i}").alias("min_value"),
            F.col(f"_hi{i}").alias("max_value"),
            F.col(f"_c{i}").alias("text_chars"),
            F.col(f"_d{i}").alias("distinct_sketch"),
            # A column without values has no number sketch to merge.
            (F.when(F.col(f"_n{i}") > 0, F.col(f"_k{i}")) if isinstance(kinds[c], T.NumericType) else F.lit(None).cast("binary")).alias("number_sketch"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(*keys, F.inline(F.array(*items)))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    """Sketch rows of any parts -> one row per column, map-side combined."""
    return sketches.groupBy("column_name", "data_type").agg(
        F.sum("total_rows").alias("total_rows"),
        F.sum("null_count").alias("null_count"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.sum("text_chars").alias("text_chars"),
        F.hll_union_agg("distinct_sketch").alias("distinct_sketch"),
        # Merging none gives an empty sketch that has no quantiles.
        F.when(F.count("number_sketch") > 0, F.kll_merge_agg_double("number_sketch")).alias("number_sketch"),
    )


def sketched_profile(sketches: DataFrame, quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """Readable profile of merged sketch rows: counts, extremes, distinct estimate and quantiles."""
    points = [F.when(F.col("number_sketch").isNotNull(), F.kll_sketch_get_quantile_double("number_sketch", F.lit(q))).alias(f"q{round(q * 100)}") for q in quantiles]
    return sketches.select(
        "column_name",
        "data_type",
        "total_rows",
        "null_count",
        F.round(F.try_divide(F.col("null_count") * 100, F.col("total_rows")), 2).alias("null_pct"),
        "min_value",
        "max_value",
        "text_chars",
        F.hll_sketch_estimate("distinct_sketch").alias("distinct_count"),
        *points,
    )
