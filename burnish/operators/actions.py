"""Single cleaning actions on a DataFrame, for use outside a rule set."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnish.functions.numbers import as_of_literal, clip, holds, is_future
from burnish.functions.text import trim_ws
from burnish.operators.profile import col_skewness, modes, outlier_bounds, variant_map
from burnish.operators.quantiles import Quantile, exact_quantiles, grouped_median
from burnish.operators.skew import attach
from burnish.plans.engine import mark_imbalances
from burnish.plans.rules import Balance, literal


def keep_where(df: DataFrame, predicate: Column) -> DataFrame:
    return df.filter(holds(predicate))


def delete_where(df: DataFrame, predicate: Column) -> DataFrame:
    """Delete matching rows; a NULL comparison is no match, so the row stays."""
    return df.filter(~holds(predicate))


def drop_sequence_break(df: DataFrame, start: str, end: str) -> DataFrame:
    return delete_where(df, F.col(start) > F.col(end))


def drop_future(df: DataFrame, column: str, as_of: str | None) -> DataFrame:
    return delete_where(df, is_future(F.col(column), as_of))


def null_fraction(df: DataFrame, column: str) -> float:
    row = df.agg(F.count(F.lit(1)).alias("n"), F.count(column).alias("m")).first()
    return 0.0 if row["n"] == 0 else 1 - row["m"] / row["n"]


def drop_null_temporal(df: DataFrame, column: str, max_rate: float = 0.05) -> DataFrame:
    """Delete rows without a date while they are few; otherwise flag and keep them."""
    flag = f"{column}_flag"
    if null_fraction(df, column) < max_rate:
        return df.filter(F.col(column).isNotNull()).withColumn(flag, F.lit(None).cast("string"))
    return df.withColumn(flag, F.when(F.col(column).isNull(), F.lit("NULL_TEMPORAL")))


def flag_when(df: DataFrame, flag: str, predicate: Column, label: str) -> DataFrame:
    return df.withColumn(flag, F.when(holds(predicate), F.lit(label)))


def flag_future(df: DataFrame, column: str, as_of: str | None, label: str) -> DataFrame:
    return flag_when(df, f"{column}_flag", F.col(column) > as_of_literal(as_of), label)


def flag_null(df: DataFrame, column: str, label: str = "NULL_MONETARY") -> DataFrame:
    return flag_when(df, f"{column}_flag", F.col(column).isNull(), label)


def abs_and_flag(df: DataFrame, column: str, label: str) -> DataFrame:
    c = F.col(column)
    return df.withColumns({column: F.abs(c), f"{column}_flag": F.when(c < 0, F.lit(label))})


def flag_negative(df: DataFrame, column: str, label: str = "NEGATIVE_MONETARY") -> DataFrame:
    return flag_when(df, f"{column}_flag", F.col(column) < 0, label)


def flag_outlier(df: DataFrame, column: str, p: float = 0.99, label: str = "OUTLIER_REVIEW") -> DataFrame:
    bound = exact_quantiles(df, [Quantile("p", f"`{column}`", p)])["p"]
    return flag_when(df, f"{column}_flag", F.col(column) > F.lit(bound), label)


def outlier_share(df: DataFrame, column: str, width: float = 3.0) -> tuple[float | None, float]:
    """Upper fence of a column and the fraction of its values beyond it."""
    bound = outlier_bounds(df, [column], width)[column]
    row = df.agg(F.count(column).alias("n"), F.count_if(F.col(column) > F.lit(bound)).alias("o")).first()
    return bound, (row["o"] / row["n"] if row["n"] else 0.0)


def flag_by_outlier_rate(df: DataFrame, column: str, limit: float = 0.05, width: float = 3.0) -> DataFrame:
    """Few outliers: mark each as a likely large deal; many: mark the whole column."""
    bound, rate = outlier_share(df, column, width)
    flag = f"{column}_flag"
    if rate < limit:
        return flag_when(df, flag, F.col(column) > F.lit(bound), "POTENTIAL_ENTERPRISE_DEAL")
    return flag_when(df, flag, F.col(column).isNotNull(), "DISTRIBUTION_REVIEW")


def winsorise(
    df: DataFrame, column: str, p: float = 0.99, low: float = 0.01, high: float = 0.05, width: float = 3.0
) -> DataFrame:
    """Cap at the p-quantile when outliers are between ``low`` and ``high`` of the values.

    Fewer are kept as they are; more put the whole column under review.
    """
    _, rate = outlier_share(df, column, width)
    flag = f"{column}_flag"
    if rate < low:
        return df.withColumn(flag, F.lit(None).cast("string"))
    if rate > high:
        return df.withColumn(flag, F.lit("DISTRIBUTION_REVIEW"))
    bound = F.lit(exact_quantiles(df, [Quantile("p", f"`{column}`", p)])["p"])
    c = F.col(column)
    return df.withColumns(
        {column: F.when(c > bound, bound).otherwise(c), flag: F.when(c > bound, F.lit("CAPPED_P99"))}
    )


def floor_zero(df: DataFrame, column: str) -> DataFrame:
    c = F.col(column)
    return df.withColumn(column, F.when(c < 0, F.lit(0).cast(df.schema[column].dataType)).otherwise(c))


def null_negative(df: DataFrame, column: str, label: str) -> DataFrame:
    c = F.col(column)
    return df.withColumns(
        {column: F.when(holds(c < 0), F.lit(None)).otherwise(c), f"{column}_flag": F.when(c < 0, F.lit(label))}
    )


def cap_upper(df: DataFrame, column: str, hi: float) -> DataFrame:
    c = F.col(column)
    return df.withColumn(column, F.when(c > hi, F.lit(float(hi))).otherwise(c))


def cap_range(df: DataFrame, column: str, lo: float, hi: float, label: str | None = None) -> DataFrame:
    c = F.col(column)
    updates = {column: clip(c, lo, hi)}
    if label:
        updates[f"{column}_flag"] = F.when((c < lo) | (c > hi), F.lit(label))
    return df.withColumns(updates)


def median_if_out_of_range(df: DataFrame, cols: list[str], lo: float, hi: float) -> DataFrame:
    """Replace out-of-range values by the median of the column's in-range values."""
    found = exact_quantiles(df, [Quantile(c, f"`{c}`", 0.5, f"`{c}` BETWEEN {lo} AND {hi}") for c in cols])
    return df.withColumns(
        {
            c: F.when((F.col(f"`{c}`") < lo) | (F.col(f"`{c}`") > hi), F.lit(found[c])).otherwise(F.col(f"`{c}`"))
            for c in cols
        }
    )


def flag_range(df: DataFrame, column: str, lo: float, hi: float, label: str) -> DataFrame:
    c = F.col(column)
    return flag_when(df, f"{column}_flag", (c > hi) | (c < lo), label)


def recompute(df: DataFrame, column: str, value: Column, when: Column) -> DataFrame:
    return df.withColumn(column, F.when(holds(when), value).otherwise(F.col(column)))


def cap_balance(df: DataFrame, used: str, left: str, share: float = 0.9) -> DataFrame:
    total = F.col(used) + F.col(left)
    return recompute(df, used, total * share, F.col(used) > total)


def round_money(df: DataFrame, cols: list[str], decimal: bool = False) -> DataFrame:
    """Round to cents; ``decimal`` also changes the type to DECIMAL(18,2)."""
    kind = "decimal(18,2)" if decimal else "double"
    return df.withColumns({c: F.round(c, 2).cast(kind) for c in cols})


def impute_median(df: DataFrame, cols: list[str]) -> DataFrame:
    found = exact_quantiles(df, [Quantile(c, f"`{c}`") for c in cols])
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(found[c])) for c in cols})


def impute_mean(df: DataFrame, cols: list[str]) -> DataFrame:
    row = df.agg(*[F.avg(c).alias(c) for c in cols])
    return df.withColumns({c: F.coalesce(F.col(c), row.select(c).scalar()) for c in cols})


def impute_group_median(df: DataFrame, column: str, by: list[str], values: list | None = None) -> DataFrame:
    """Fill NULLs with the median of the row's group.

    With listed ``values`` (of one group column) the medians are a fixed handful and
    become literals; otherwise every group's median is joined back.
    """
    if values is not None:
        (group,) = by
        found = exact_quantiles(
            df, [Quantile(str(v), f"`{column}`", 0.5, f"`{group}` = {literal(v)}") for v in values]
        )
        filled = reduce(
            lambda out, v: F.when(F.col(group) == v, F.lit(found[str(v)]).cast("double")).otherwise(out),
            values,
            F.lit(None).cast("double"),
        )
        return df.withColumn(column, F.coalesce(F.col(column), filled))
    medians = grouped_median(df, by, column, "_median")
    return (
        attach(df, medians, by)
        .withColumn(column, F.coalesce(F.col(column), F.col("_median")))
        .drop("_median")
    )


def impute_mode(df: DataFrame, cols: list[str]) -> DataFrame:
    found = modes(df, cols)
    return df.withColumns({c: F.coalesce(F.col(f"`{c}`"), F.lit(found[c])) for c in cols})


def impute_const(df: DataFrame, cols: list[str], value="UNKNOWN") -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value)) for c in cols})


def impute_regression(df: DataFrame, target: str, predictor: str) -> DataFrame:
    """Fill from a least-squares line on the predictor; median where that is NULL too."""
    line = df.agg(
        F.regr_slope(target, predictor).alias("slope"), F.regr_intercept(target, predictor).alias("intercept")
    ).first()
    median = exact_quantiles(df, [Quantile("m", f"`{target}`")])["m"]
    fitted = F.lit(line["slope"]).cast("double") * F.col(predictor) + F.lit(line["intercept"]).cast("double")
    return df.withColumn(target, F.coalesce(F.col(target), fitted, F.lit(median).cast("double")))


def impute_by_skew(df: DataFrame, cols: list[str], limit: float = 2.0) -> DataFrame:
    """Median for skewed columns, mean for the others."""
    skew = {r["column_name"]: r["skewness"] for r in col_skewness(df, cols).collect()}
    skewed = [c for c in cols if skew[c] is not None and skew[c] > limit]
    even = [c for c in cols if c not in skewed]
    out = impute_median(df, skewed) if skewed else df
    if even:
        row = df.agg(*[F.avg(c).alias(c) for c in even]).first()
        out = out.withColumns({c: F.coalesce(F.col(c), F.lit(row[c]).cast("double")) for c in even})
    return out


def drop_sparse(df: DataFrame, limit: float = 0.30) -> DataFrame:
    """Drop columns whose NULL share is above the limit."""
    row = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(c).alias(f"m{i}") for i, c in enumerate(df.columns)]).first()
    sparse = [c for i, c in enumerate(df.columns) if row["n"] and 1 - row[f"m{i}"] / row["n"] > limit]
    return df.drop(*sparse)


def standardise_learned(df: DataFrame, column: str, uppercase: bool = False) -> DataFrame:
    """Replace each spelling by the most frequent one of its cluster."""
    out = attach(df, variant_map(df, column), [column])
    value = F.upper("canonical") if uppercase else F.col("canonical")
    return out.withColumn(column, value).drop("canonical").select(*df.columns)


def flag_orphan(df: DataFrame, column: str, master: DataFrame, key: str, label: str = "ORPHANED_FK") -> DataFrame:
    """Flag keys missing from the master; rows and NULL keys are kept unflagged."""
    keys = (
        master.select(F.col(key).alias(column))
        .filter(F.col(column).isNotNull())
        .distinct()
        .withColumn("_known", F.lit(True))
    )
    missing = F.col(column).isNotNull() & F.col("_known").isNull()
    return attach(df, keys, [column]).withColumn(f"{column}_flag", F.when(missing, F.lit(label))).drop("_known")


def flag_group(
    df: DataFrame, key: str, a: str, b: str, label: str, tol: float = 0.01, where: str | None = None,
    flag: str | None = None,
) -> DataFrame:
    """Flag every row (in scope) of a group whose two sums differ."""

    marked = mark_imbalances(df, [Balance(key, a, b, "_off", tol, where)])
    return marked.withColumn(flag or f"{key}_flag", F.when(F.col("_off"), F.lit(label))).drop("_off")
