"""Type inference and row-level casts that keep what they reject."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.plans.decide import TEMPORAL_NAME

LONG_LIMIT = float(1 << 63)
# How a number prints: no plus sign, no leading zero, nothing but an exponent behind it.
NUMBER = r"^\s*-?(0|[1-9][0-9]*|(?=\.[0-9]))(\.[0-9]*)?([eE][+-]?[0-9]+)?\s*$"


def is_temporal_name(name: str) -> bool:
    """Name of a date or time column.  Flags about a date are not dates."""
    lowered = name.lower()
    return not lowered.endswith("_flag") and re.search(TEMPORAL_NAME, lowered) is not None


def sanitise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().replace(" ", "_").replace("-", "_").upper() for c in df.columns])


def infer_types(df: DataFrame, sample_rows: int | None = None) -> DataFrame:
    """(column_name, data_type, max_len) from one map-side aggregation over the whole input.

    A type is chosen only if every value has it: BIGINT if all cast to it, DECIMAL(38,0)
    for longer whole numbers, text for longer ones still; whole-number doubles become
    BIGINT within its range; a temporal type needs the name as well.  Values that a number
    would not give back are codes and stay text: leading zeros, plus signs, letters other than
    an exponent, and exponents where no value of the column has a decimal point.  ``sample_rows``
    looks at some rows only; the casts that follow then count what did not fit.
    """
    sample = df if sample_rows is None else df.limit(sample_rows)
    aggs: list[Column] = []
    for i, f in enumerate(df.schema.fields):
        c = F.col(f"`{f.name}`")
        text = c.cast("string")
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.max(F.length(text)).alias(f"len{i}"),
        ]
        if isinstance(f.dataType, T.StringType):
            aggs += [
                F.count(text.try_cast("double")).alias(f"num{i}"),
                F.count(text.try_cast("bigint")).alias(f"int{i}"),
                F.count(text.try_cast("decimal(38,0)")).alias(f"dec{i}"),
                F.count_if(text.rlike("[.eE]")).alias(f"dot{i}"),
                F.count_if(text.contains(".")).alias(f"point{i}"),
                F.count_if(text.rlike("[eE]")).alias(f"exp{i}"),
                F.count_if(~text.rlike(NUMBER)).alias(f"code{i}"),
                F.count(text.try_cast("timestamp")).alias(f"ts{i}"),
            ]
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            aggs.append(F.count_if((c == F.floor(c)) & (F.abs(c) < LONG_LIMIT)).alias(f"whole{i}"))
    row = sample.agg(*aggs)
    items = []
    for i, f in enumerate(df.schema.fields):
        n = F.col(f"n{i}")
        if isinstance(f.dataType, T.StringType):
            code = (F.col(f"code{i}") > 0) | ((F.col(f"exp{i}") > 0) & (F.col(f"point{i}") == 0))
            numeric = (n > 0) & (F.col(f"num{i}") == n) & ~code
            kind = (
                F.when(numeric & (F.col(f"dot{i}") > 0), F.lit("double"))
                .when(numeric & (F.col(f"int{i}") == n), F.lit("bigint"))
                .when(numeric & (F.col(f"dec{i}") == n), F.lit("decimal(38,0)"))
            )
            if is_temporal_name(f.name):
                kind = kind.when((n > 0) & (F.col(f"ts{i}") == n), F.lit("timestamp_ntz"))
            kind = kind.otherwise(F.lit("string"))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            kind = F.when((n > 0) & (F.col(f"whole{i}") == n), F.lit("bigint")).otherwise(F.lit("double"))
        elif isinstance(f.dataType, T.IntegralType):
            kind = F.lit("bigint")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            kind = F.lit("timestamp_ntz")
        elif isinstance(f.dataType, T.BooleanType):
            kind = F.lit("boolean")
        else:
            kind = F.lit("string")
        items.append(
            F.struct(
                F.lit(f.name).alias("column_name"),
                kind.alias("data_type"),
                F.col(f"len{i}").cast("bigint").alias("max_len"),
            )
        )
    return row.select(F.inline(F.array(*items)))


def inferred_schema(types: DataFrame) -> dict[str, str]:
    """Inferred types as a mapping (one entry per column)."""
    return {r["column_name"]: r["data_type"] for r in types.collect()}


def cast_or_reject(df: DataFrame, schema: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Rows with every value castable, and the others with the columns that failed.

    Both sides come from the same row-local expressions; nothing is shuffled.
    """
    cast = {c: F.col(f"`{c}`").try_cast(t) for c, t in schema.items()}
    failed = [
        F.when(F.col(f"`{c}`").isNotNull() & value.isNull(), F.lit(c)) for c, value in cast.items()
    ]
    judged = df.withColumn("_bad", F.array_compact(F.array(*failed)))
    ok = judged.filter(F.size("_bad") == 0).select(
        *[cast[c].alias(c) if c in cast else F.col(f"`{c}`") for c in df.columns]
    )
    rejected = judged.filter(F.size("_bad") > 0).select(
        *df.columns,
        F.array_join("_bad", ",").alias("reject_columns"),
        F.concat(F.lit("cannot cast "), F.array_join("_bad", ",")).alias("reject_reason"),
    )
    return ok, rejected


def reject_counts(rejected: DataFrame) -> DataFrame:
    """Rejected rows per failing column set."""
    return rejected.groupBy("reject_columns").agg(F.count(F.lit(1)).alias("rejected_rows"))
