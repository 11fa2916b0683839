"""Column and table profiles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.functions.aggregates import pearson
from burnish.functions.numbers import holds
from burnish.functions.text import trim_ws
from burnish.operators.gram import correlation_matrix
from burnish.operators.quantiles import Quantile, exact_quantiles



def _numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def _types(df: DataFrame, cols: list[str]) -> Column:
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return F.create_map(*[F.lit(x) for c in cols for x in (c, kinds[c])])[F.col("column_name")]


def profile_columns(df: DataFrame, cols: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Type, null count, null percentage and distinct count per column.

    Exact distincts come from counting each (column, value) once, map-side combined,
    instead of one wide Expand over all columns.  An integer travels as it is, any
    other value as a 128-bit hash, so a unique text column shuffles two numbers a row and
    not its texts.  ``approx`` uses
    sketches in a single aggregation without that shuffle and adds a sketched median.
    """
    cols = cols or df.columns
    if approx:
        return _profile_sketched(df, cols)

    def cell(i: int, c: str) -> Column:
        value = F.col(f"`{c}`")
        if "map<" in df.schema[c].dataType.simpleString():
            value = value.cast("string")
        if isinstance(df.schema[c].dataType, T.IntegralType):
            return F.struct(F.lit(i).alias("i"), value.cast("bigint").alias("a"), F.lit(None).cast("bigint").alias("b"))
        known = value.isNotNull()
        return F.struct(
            F.lit(i).alias("i"), F.when(known, F.xxhash64(value)).alias("a"), F.when(known, F.xxhash64(F.lit(1), value)).alias("b")
        )

    cells = df.select(F.inline(F.array(*[cell(i, c) for i, c in enumerate(cols)])))
    counted = cells.groupBy("i", "a", "b").agg(F.count(F.lit(1)).alias("n"))
    names = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("i") + 1)
    return (
        counted.groupBy("i")
        .agg(
            F.sum("n").alias("total_rows"),
            F.coalesce(F.sum(F.when(F.col("a").isNull(), F.col("n"))), F.lit(0)).alias("null_count"),
            F.count("a").alias("distinct_count"),
        )
        .withColumn("column_name", names)
        .select(
            "column_name",
            _types(df, cols).alias("data_type"),
            "total_rows",
            "null_count",
            F.round(F.try_divide(F.col("null_count") * 100, F.col("total_rows")), 2).alias("null_pct"),
            "distinct_count",
        )
    )


def _profile_sketched(df: DataFrame, cols: list[str]) -> DataFrame:
    numbers = set(_numeric(df))
    aggs = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(cols):
        aggs += [F.count(c).alias(f"n{i}"), F.approx_count_distinct(c, 0.01).alias(f"d{i}")]
        if c in numbers:
            aggs.append(F.kll_sketch_agg_double(F.col(c).cast("double")).alias(f"k{i}"))
    row = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(df.schema[c].dataType.simpleString()).alias("data_type"),
            F.col("total").alias("total_rows"),
            (F.col("total") - F.col(f"n{i}")).alias("null_count"),
            F.round(F.try_divide((F.col("total") - F.col(f"n{i}")) * 100, F.col("total")), 2).alias("null_pct"),
            F.col(f"d{i}").alias("distinct_count"),
            (
                F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(f"k{i}", F.lit(0.5)))
                if c in numbers
                else F.lit(None).cast("double")
            ).alias("approx_median"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*items)))


def column_ranges(df: DataFrame, cols: list[str]) -> DataFrame:
    """Minimum, maximum and type mix per column, in one aggregation."""
    numbers = set(_numeric(df))
    aggs = []
    for i, c in enumerate(cols):
        value = F.col(c)
        number = value.cast("double") if c in numbers else value.cast("string").try_cast("double")
        aggs += [
            F.min(number).alias(f"lo{i}"),
            F.max(number).alias(f"hi{i}"),
            F.count(value).alias(f"n{i}"),
            F.count(number).alias(f"m{i}"),
        ]
    row = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
            F.col(f"m{i}").alias("numeric_values"),
            (F.col(f"n{i}") - F.col(f"m{i}")).alias("text_values"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*items)))


def profile_metadata(df: DataFrame, name: str, method: str = "full_scan", sample_size: int | None = None) -> DataFrame:
    """Table name, time, row count, sample size and method."""
    rows = F.count(F.lit(1))
    return df.agg(rows.alias("total_rows")).select(
        F.lit(name).alias("table_name"),
        F.current_timestamp().alias("profiled_at"),
        "total_rows",
        (F.col("total_rows") if sample_size is None else F.least(F.col("total_rows"), F.lit(sample_size))).alias(
            "sample_size"
        ),
        F.lit(method).alias("sample_method"),
    )


def null_cells(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Total cells, null cells and their percentage."""
    cols = cols or df.columns
    nulls = reduce(lambda a, b: a + b, [F.count(F.lit(1)) - F.count(c) for c in cols])
    return df.agg(
        (F.count(F.lit(1)) * len(cols)).alias("total_cells"), nulls.alias("null_cells")
    ).withColumn("null_pct", F.try_divide(F.col("null_cells") * 100, F.col("total_cells")))


def _long(df: DataFrame, cols: list[str], aggregate, name: str) -> DataFrame:
    row = df.agg(*[aggregate(c).alias(f"a{i}") for i, c in enumerate(cols)])
    items = [
        F.struct(F.lit(c).alias("column_name"), F.col(f"a{i}").alias(name)) for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*items)))


def null_rate(df: DataFrame, cols: list[str]) -> DataFrame:
    return _long(
        df, cols, lambda c: F.try_divide(F.count_if(F.col(c).isNull()) * 100, F.count(F.lit(1))), "null_pct"
    )


def col_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    return _long(df, cols, F.avg, "mean")


def col_skewness(df: DataFrame, cols: list[str]) -> DataFrame:
    return _long(df, cols, F.skewness, "skewness")


def col_quantile(df: DataFrame, cols: list[str], p: float) -> DataFrame:
    found = exact_quantiles(df, [Quantile(c, f"`{c}`", p) for c in cols])
    return df.sparkSession.createDataFrame(
        [(c, p, found[c]) for c in cols], "column_name string, p double, quantile double"
    )


def col_median(df: DataFrame, cols: list[str]) -> DataFrame:
    return col_quantile(df, cols, 0.5).select("column_name", F.col("quantile").alias("median"))


def col_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    """Most frequent value per column as text, lowest on a tie; all columns counted in one shuffle.

    Ties are settled on the value, not on its text: 9 is lower than 10.
    """

    def cell(c: str) -> Column:
        kind, value = df.schema[c].dataType, F.col(f"`{c}`")
        whole = isinstance(kind, (T.IntegralType, T.DecimalType))
        return F.struct(
            F.lit(c).alias("column_name"),
            value.cast("string").alias("value"),
            (value.cast("decimal(38,9)") if whole else F.lit(None).cast("decimal(38,9)")).alias("exact"),
            (value.cast("double") if isinstance(kind, T.NumericType) else F.lit(None).cast("double")).alias("number"),
        )

    cells = df.select(F.inline(F.array(*[cell(c) for c in cols]))).filter("value IS NOT NULL")
    counted = cells.groupBy("column_name", "value", "exact", "number").agg(F.count(F.lit(1)).alias("n"))
    # Highest count first; among equals the lowest value.
    place = F.struct(-F.col("n"), F.col("exact"), F.col("number"), F.col("value"))
    return counted.groupBy("column_name").agg(F.min_by("value", place).alias("mode"), F.max("n").alias("rows"))


def modes(df: DataFrame, cols: list[str]) -> dict:
    """Mode of each column in its own type; None for a column without values."""
    if not cols:
        return {}
    found = {r["column_name"]: r["mode"] for r in col_mode(df, cols).collect()}
    row = df.sparkSession.range(1).select(
        *[F.lit(found.get(c)).cast(df.schema[c].dataType).alias(f"m{i}") for i, c in enumerate(cols)]
    )
    return dict(zip(cols, row.first()))


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson r of each pair, all in one aggregation."""
    row = df.agg(*[pearson(F.col(a), F.col(b)).alias(f"r{i}") for i, (a, b) in enumerate(pairs)])
    items = [
        F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), F.col(f"r{i}").alias("r"))
        for i, (a, b) in enumerate(pairs)
    ]
    return row.select(F.inline(F.array(*items)))


def outlier_bounds(df: DataFrame, cols: list[str], width: float = 3.0) -> dict[str, float | None]:
    """Upper fence Q3 + width x IQR per column."""
    found = exact_quantiles(
        df, [Quantile(f"{c}|{q}", f"`{c}`", q) for c in cols for q in (0.25, 0.75)]
    )
    out = {}
    for c in cols:
        q1, q3 = found[f"{c}|0.25"], found[f"{c}|0.75"]
        out[c] = None if q1 is None else q3 + width * (q3 - q1)
    return out


def outlier_rate(
    df: DataFrame, cols: list[str], method: str = "iqr", width: float = 3.0, bounds: dict[str, float] | None = None
) -> DataFrame:
    """Percentage of non-null values above the fence (or above given bounds)."""
    limits = bounds if method == "fixed" else outlier_bounds(df, cols, width)
    row = df.agg(
        *[F.count(c).alias(f"n{i}") for i, c in enumerate(cols)],
        *[F.count_if(F.col(c) > F.lit(limits[c])).alias(f"o{i}") for i, c in enumerate(cols)],
    )
    items = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.lit(limits[c]).cast("double").alias("bound"),
            F.col(f"o{i}").alias("outliers"),
            F.try_divide(F.col(f"o{i}") * 100, F.col(f"n{i}")).alias("outlier_pct"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*items)))


def value_list(df: DataFrame, column: str, n: int = 6) -> DataFrame:
    """The first ``n`` distinct values as one sorted array."""
    firsts = df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).limit(n)
    return firsts.agg(F.sort_array(F.collect_list(column)).alias("value_list"))


def value_lists(df: DataFrame, cols: list[str], n: int = 6) -> DataFrame:
    """(column_name, value_list): the first ``n`` distinct values of each column as text, one pass for all."""
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]
    found = df.select(F.inline(F.array(*cells))).filter("value IS NOT NULL").distinct()
    place = F.row_number().over(Window.partitionBy("column_name").orderBy("value"))
    firsts = found.withColumn("_n", place).filter(F.col("_n") <= n)
    return firsts.groupBy("column_name").agg(F.sort_array(F.collect_list("value")).alias("value_list"))


def value_counts(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("cnt"))
    if n is None:
        return counts
    return counts.orderBy(F.desc("cnt"), F.asc_nulls_last(column)).limit(n)


def variant_clusters(df: DataFrame, column: str) -> DataFrame:
    """Spellings that agree after TRIM + UPPER: cluster, most frequent spelling, sizes."""
    raw = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    best = F.max_by(F.col(column), F.struct(F.col("n"), F.col(column)))
    return raw.groupBy(F.upper(trim_ws(F.col(column))).alias("cluster")).agg(
        best.alias("canonical"), F.count(F.lit(1)).alias("variants"), F.sum("n").alias("rows")
    )


def variant_map(df: DataFrame, column: str) -> DataFrame:
    """Spelling to the most frequent spelling of its TRIM + UPPER cluster."""
    raw = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    raw = raw.withColumn("_cluster", F.upper(trim_ws(F.col(column))))
    best = raw.groupBy("_cluster").agg(
        F.max_by(F.col(column), F.struct(F.col("n"), F.col(column))).alias("canonical")
    )
    return raw.join(best, "_cluster").select(column, trim_ws(F.col("canonical")).alias("canonical"))


def contradictions(df: DataFrame, constraints: dict[str, str]) -> DataFrame:
    """Rows breaking each user-given constraint (SQL condition that should never hold)."""
    row = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(holds(F.expr(e))).alias(f"n{i}") for i, e in enumerate(constraints.values())],
    )
    items = [
        F.struct(
            F.lit(name).alias("constraint_name"),
            F.col(f"n{i}").alias("violations"),
            F.try_divide(F.col(f"n{i}") * 100, F.col("total")).alias("violation_pct"),
        )
        for i, name in enumerate(constraints)
    ]
    return row.select(F.inline(F.array(*items)))


def correlated_pairs(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """Column pairs with |r| above the threshold, however many columns: one pass over the table."""
    cols = cols or _numeric(df)
    return correlation_matrix(df, cols).filter(F.abs("r") > threshold).select("column_a", "column_b", "r")


def numeric_summary(df: DataFrame, cols: list[str]) -> DataFrame:
    aggs = []
    for i, c in enumerate(cols):
        aggs += [
            F.count(c).alias(f"n{i}"),
            F.sum(c).alias(f"s{i}"),
            F.avg(c).alias(f"a{i}"),
            F.min(c).alias(f"lo{i}"),
            F.max(c).alias(f"hi{i}"),
        ]
    row = df.agg(*aggs)
    items = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.col(f"n{i}").alias("count_values"),
            F.col(f"s{i}").alias("sum_value"),
            F.col(f"a{i}").alias("avg_value"),
            F.col(f"lo{i}").alias("min_value"),
            F.col(f"hi{i}").alias("max_value"),
        )
        for i, c in enumerate(cols)
    ]
    return row.select(F.inline(F.array(*items)))


def null_rate_by_group(profile: DataFrame, groups: dict[str, str]) -> DataFrame:
    """Average null percentage per column group."""
    group = F.create_map(*[F.lit(x) for item in groups.items() for x in item])[F.col("column_name")]
    return (
        profile.withColumn("column_group", group)
        .filter("column_group IS NOT NULL")
        .groupBy("column_group")
        .agg(F.count(F.lit(1)).alias("columns"), F.avg("null_pct").alias("avg_null_pct"))
    )


def count_shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)).cast("bigint"))
