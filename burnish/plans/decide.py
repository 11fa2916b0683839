"""Column classes, the decision tree, and its translation into rules."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.functions.numbers import as_of_literal, holds
from burnish.operators.profile import correlations, outlier_rate, profile_columns, variant_map
from burnish.plans.engine import SPELLED, group_imbalance
from burnish.plans.rules import Balance, Rule, Stat
from burnish.session import materialise

# Name patterns (lower case) and band limits in percent.
TEMPORAL_NAME = r"(?:^|_)(?:date|timestamp|time)(?:_|$)|_at$"
PII_NAME = r"(^|_)(e_?mail|phone|mobile)(_|$)|(^|_)(customer|full|first|last|contact|person|employee|c|s)_name$|^name$"
MONEY_NAME = (
    r"(^|_)(amount|price|salary|comp|cost|revenue|totalprice|extendedprice|retailprice|acctbal|"
    r"arr|mrr|ltv|cac|bonus|grant|fee|usd|eur|gbp|inr|jpy|cny)(_|$)"
)
KEY_NAME = r"(^|_)(id|key|seq|custkey|orderkey|partkey|suppkey)$"
SCHEDULED_NAME = r"(^|_)(order|due|deliver\w*|schedul\w*|plan\w*|expect\w*|renew\w*|expir\w*|go_live|launch|end|until)(_|$)"
REFUND_NAME = r"(^|_)(refund\w*|credit\w*|return\w*|chargeback\w*)(_|$)"
UNIQUE_SHARE = 0.9
# Text with more values than this share of its rows is free text, however few or many rows there are.
FREE_TEXT_SHARE = 0.2
NUMERIC_LOW, NUMERIC_HIGH = 10.0, 30.0
TEXT_LOW, TEXT_HIGH = 5.0, 15.0
TEMPORAL_LIMIT = 5.0
OUTLIER_LOW, OUTLIER_HIGH = 1.0, 5.0
SKEW_LIMIT = 2.0
CORRELATION_LIMIT = 0.7


def classify_columns(profile: DataFrame, overrides: dict[str, str] | None = None) -> DataFrame:
    """Class per column from name, type and uniqueness; given classes win."""
    name = F.lower("column_name")
    kind = F.col("data_type")
    numeric = kind.rlike("^(tinyint|smallint|int|bigint|float|double|decimal)")
    filled = F.col("total_rows") - F.col("null_count")
    share = F.try_divide(F.col("distinct_count"), filled)
    is_key = name.rlike(KEY_NAME)
    guess = (
        F.when(name.endswith("_flag"), F.lit("CATEGORY"))
        .when(kind.rlike("^(timestamp|date)"), F.lit("TEMPORAL"))
        .when(is_key & (share >= UNIQUE_SHARE), F.lit("NUMERIC_PK"))
        .when(is_key, F.lit("REFERENCE"))
        .when(name.rlike(PII_NAME) & ~numeric, F.lit("PII"))
        .when(name.rlike(MONEY_NAME) & numeric, F.lit("MONETARY"))
        .when(numeric, F.lit("NUMERIC"))
        .when(share > FREE_TEXT_SHARE, F.lit("TEXT"))
        .otherwise(F.lit("CATEGORY"))
    )
    given = F.lit(None).cast("string")
    for column, cls in (overrides or {}).items():
        given = F.when(F.col("column_name") == column, F.lit(cls)).otherwise(given)
    return profile.withColumn("column_class", F.coalesce(given, guess))


@dataclass(frozen=True)
class Constraint:
    """Something a user knows about the columns: ``when`` (SQL) holds for rows that break it.

    Kinds: ``sequence`` (rows are deleted), ``bounds`` (values are capped to ``value``),
    ``identity`` (recomputed as ``value``), ``physics`` and ``orphan`` (flagged), and
    ``balance`` (groups of ``when`` whose sums of ``column`` and ``value`` differ are flagged).
    """

    kind: str
    column: str
    when: str
    value: str | None = None


def sequence(start: str, end: str) -> Constraint:
    return Constraint("sequence", f"{start}/{end}", f"`{start}` > `{end}`")


def bounds(column: str, low: float, high: float) -> Constraint:
    return Constraint("bounds", column, f"`{column}` < {low} OR `{column}` > {high}", f"least(greatest(`{column}`, {low}), {high})")


_CONSTRAINED = {
    "sequence": ("DELETE_ROWS", "IMPOSSIBLE_SEQUENCE"),
    "bounds": ("CAP_RANGE", "DOMAIN_BOUNDS"),
    "identity": ("RECOMPUTE", "LOGIC_VIOLATION"),
    "physics": ("FLAG_PHYSICS", "PHYSICS"),
    "orphan": ("FLAG_ORPHAN", "FK_VIOLATION"),
    "balance": ("FLAG_JOURNAL", "JOURNAL_BALANCE"),
}


def broken_constraints(df: DataFrame, constraints: list[Constraint]) -> DataFrame:
    """Plan rows of the constraints that some row, or some group, breaks: one aggregation for all of the former."""
    spark, schema = df.sparkSession, "column_name string, action string, rule string, detail string"
    plain = [c for c in constraints if c.kind != "balance"]
    found = []
    if plain:
        row = df.agg(*[F.count_if(F.expr(c.when)).alias(f"n{i}") for i, c in enumerate(plain)]).first()
        found = [c for i, c in enumerate(plain) if row[f"n{i}"]]
    found += [c for c in constraints if c.kind == "balance" and not group_imbalance(df, Balance(c.when, c.column, c.value, "_off")).isEmpty()]
    rows = [(c.column, *_CONSTRAINED[c.kind], json.dumps({"when": c.when, "value": c.value})) for c in found]
    return spark.createDataFrame(rows, schema)


def measure(
    df: DataFrame,
    as_of: str | None = None,
    overrides: dict[str, str] | None = None,
    approx: bool = False,
    profile: DataFrame | None = None,
) -> DataFrame:
    """Profile with class, skewness, outlier share, negatives, future dates and best predictor.

    ``profile`` is one already computed; otherwise it is computed once and stored.
    """
    if profile is None:
        profile = materialise(profile_columns(df, approx=approx), "profile")
    profile = profile.drop("approx_median")
    typed = classify_columns(profile, overrides)
    types = {f.name: f.dataType for f in df.schema.fields}
    numbers = [c for c, t in types.items() if isinstance(t, T.NumericType)]
    moments = [c for c, t in types.items() if isinstance(t, (T.TimestampNTZType, T.TimestampType, T.DateType))]
    aggs = [
        *[F.skewness(c).alias(f"k{i}") for i, c in enumerate(numbers)],
        *[F.count_if(F.col(c) < 0).alias(f"g{i}") for i, c in enumerate(numbers)],
        *[F.count_if(F.col(c) > as_of_literal(as_of)).alias(f"u{i}") for i, c in enumerate(moments)],
    ]
    empty = F.lit(None).cast("double")
    zero = F.lit(0).cast("bigint")
    items = [
        F.struct(
            F.lit(c).alias("column_name"), F.col(f"k{i}").alias("skewness"), F.col(f"g{i}").alias("negatives"),
            zero.alias("futures"),
        )
        for i, c in enumerate(numbers)
    ] + [
        F.struct(
            F.lit(c).alias("column_name"), empty.alias("skewness"), zero.alias("negatives"),
            F.col(f"u{i}").alias("futures"),
        )
        for i, c in enumerate(moments)
    ]
    out = typed
    if items:
        out = out.join(F.broadcast(df.agg(*aggs).select(F.inline(F.array(*items)))), "column_name", "left")
    else:
        out = out.withColumns({"skewness": empty, "negatives": zero, "futures": zero})
    # Outlier fences and predictors only where the tree asks for them.
    names = {r["column_name"]: r for r in typed.select("column_name", "column_class", "null_pct").collect()}
    fenced = [c for c in numbers if names[c]["column_class"] in ("MONETARY", "NUMERIC")]
    if fenced:
        out = out.join(
            F.broadcast(outlier_rate(df, fenced).select("column_name", "outlier_pct")), "column_name", "left"
        )
    else:
        out = out.withColumn("outlier_pct", empty)
    plain = [c for c in numbers if names[c]["column_class"] == "NUMERIC"]
    targets = [c for c in plain if NUMERIC_LOW <= names[c]["null_pct"] <= NUMERIC_HIGH]
    if targets and len(plain) > 1:
        return out.join(F.broadcast(predictors(df, targets, plain)), "column_name", "left")
    return out.withColumn("predictor", F.lit(None).cast("string"))


def wants_predictor() -> Column:
    """Numbers of the middle band; which of them are filled from another column the tree decides."""
    return (F.col("column_class") == "NUMERIC") & F.coalesce(F.col("null_pct").between(NUMERIC_LOW, NUMERIC_HIGH), F.lit(False))


def predictors(df: DataFrame, targets: list[str], among: list[str]) -> DataFrame:
    """(column_name, predictor) of the targets that correlate strongly enough with another column."""
    pairs = [(t, c) for t in targets for c in among if c != t]
    found = correlations(df, pairs).filter(F.abs("r") > CORRELATION_LIMIT)
    return found.groupBy(F.col("column_a").alias("column_name")).agg(
        F.max_by("column_b", F.struct(F.abs("r"), F.col("column_b"))).alias("predictor")
    )


def _act(condition: Column, action: str, rule: str) -> Column:
    return F.when(holds(condition), F.struct(F.lit(action).alias("action"), F.lit(rule).alias("rule")))


def decide(
    measured: DataFrame,
    overrides: dict[str, list[tuple[str, str]]] | None = None,
    has_refund: bool | None = None,
    broken: DataFrame | None = None,
) -> DataFrame:
    """Actions per column by the tree.  Band limits themselves belong to the middle band.

    ``has_refund`` is looked up among the column names unless it is given.  ``broken`` is
    what ``broken_constraints`` found.  Free text and references are left as they are.
    """
    if has_refund is None:
        has_refund = not measured.filter(F.lower("column_name").rlike(REFUND_NAME)).isEmpty()
    cls = F.col("column_class")
    nulls = F.col("null_pct")
    has_nulls = F.col("null_count") > 0
    outliers = F.coalesce("outlier_pct", F.lit(0.0))
    filled = F.col("total_rows") - F.col("null_count")
    name = F.lower("column_name")
    money, moment, pii = cls == "MONETARY", cls == "TEMPORAL", cls == "PII"
    key, number, text = cls == "NUMERIC_PK", cls == "NUMERIC", cls == "CATEGORY"
    predicted = F.col("predictor").isNotNull()
    middle = (nulls >= NUMERIC_LOW) & (nulls <= NUMERIC_HIGH)
    acts = [
        _act(key & has_nulls, "DELETE_NULL_KEY", "PK_NULL"),
        _act(key & (F.col("distinct_count") < filled), "DELETE_DUPLICATES", "PK_VIOLATION"),
        _act(moment & has_nulls & (nulls < TEMPORAL_LIMIT), "DELETE_NULL_TEMPORAL", "TEMPORAL_NULL_LOW"),
        _act(moment & has_nulls & (nulls >= TEMPORAL_LIMIT), "FLAG_NULL", "TEMPORAL_NULL_HIGH"),
        _act(moment & (F.col("futures") > 0) & name.rlike(SCHEDULED_NAME), "FLAG_FUTURE", "TEMPORAL_SCHEDULED"),
        _act(moment & (F.col("futures") > 0) & ~name.rlike(SCHEDULED_NAME), "DELETE_FUTURE", "TEMPORAL_FUTURE"),
        _act(money & has_nulls, "FLAG_NULL", "MONETARY_NULL"),
        _act(
            money & (F.col("negatives") > 0),
            "CONVERT_TO_POSITIVE" if has_refund else "FLAG_NEGATIVE",
            "MONETARY_NEGATIVE",
        ),
        _act(money & (outliers > 0) & (outliers < OUTLIER_HIGH), "FLAG_OUTLIER", "MONETARY_OUTLIER"),
        _act(money & (outliers >= OUTLIER_HIGH), "FLAG_DISTRIBUTION", "MONETARY_OUTLIER"),
        _act(pii & name.contains("mail"), "NULLIFY_MALFORMED", "PII_EMAIL"),
        _act(pii & name.rlike("phone|mobile"), "STANDARDIZE_PHONE", "PII_PHONE"),
        _act(pii & name.contains("name"), "TRIM_WHITESPACE", "PII_CLEANUP"),
        _act(number & has_nulls & (nulls < NUMERIC_LOW) & (F.col("skewness") > SKEW_LIMIT), "IMPUTE_MEDIAN",
             "NUMERIC_NULL_LOW"),
        _act(number & has_nulls & (nulls < NUMERIC_LOW) & ~holds(F.col("skewness") > SKEW_LIMIT), "IMPUTE_MEAN",
             "NUMERIC_NULL_LOW"),
        _act(number & has_nulls & middle & predicted, "IMPUTE_REGRESSION", "NUMERIC_NULL_MEDIUM"),
        _act(number & has_nulls & middle & ~predicted, "IMPUTE_MEDIAN", "NUMERIC_NULL_MEDIUM"),
        _act(number & (nulls > NUMERIC_HIGH), "DROP_COLUMN", "NUMERIC_NULL_HIGH"),
        _act(number & (outliers >= OUTLIER_LOW) & (outliers <= OUTLIER_HIGH), "CAP_P99", "NUMERIC_OUTLIER"),
        _act(number & (outliers > OUTLIER_HIGH), "FLAG_DISTRIBUTION", "NUMERIC_OUTLIER"),
        _act(text, "STANDARDIZE", "CATEGORY_CONSISTENCY"),
        _act(text & has_nulls & (nulls < TEXT_LOW), "IMPUTE_MODE", "TEXT_NULL_LOW"),
        _act(text & has_nulls & (nulls >= TEXT_LOW) & (nulls <= TEXT_HIGH), "IMPUTE_UNKNOWN", "TEXT_NULL_MEDIUM"),
        _act(text & (nulls > TEXT_HIGH), "FLAG_NULL", "TEXT_NULL_HIGH"),
    ]
    tree = F.array_compact(F.array(*acts))
    for column, given in (overrides or {}).items():
        fixed = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(r).alias("rule")) for a, r in given])
        if not given:
            fixed = F.filter(tree, lambda x: F.lit(False))
        tree = F.when(F.col("column_name") == column, fixed).otherwise(tree)
    plan = measured.select(
        "column_name", "column_class", "null_pct", "predictor", F.explode(tree).alias("_a")
    ).select("column_name", "column_class", "null_pct", "_a.action", "_a.rule", "predictor", F.lit(None).cast("string").alias("detail"))
    if broken is None:
        return plan
    about = measured.select("column_name", "column_class", "null_pct")
    more = broken.join(F.broadcast(about), "column_name", "left")
    return plan.unionByName(more.withColumn("predictor", F.lit(None).cast("string")))


def recommendations(plan: DataFrame) -> DataFrame:
    return plan.select("action", "column_name", "rule")


def learn_spellings(df: DataFrame, plan: DataFrame) -> dict[str, DataFrame]:
    """Spelling to the most frequent spelling of its cluster, for each column to standardise.

    The dictionaries stay tables, for ``plan_to_rules`` and ``clean`` alike: a category may have
    many millions of values in a table that is large enough.
    """
    columns = [r["column_name"] for r in plan.filter("action = 'STANDARDIZE'").select("column_name").distinct().collect()]
    return {c: variant_map(df, c) for c in sorted(columns)}


def plan_to_rules(
    plan: DataFrame,
    as_of: str | None = None,
    keys: list[str] = (),
    spellings: dict[str, DataFrame] | None = None,
) -> tuple[list[Rule], list[str]]:
    """Rules for the engine, and the columns to drop.  The plan has a few rows per column.

    That a column looks like a key is a guess: rows are deleted for a missing or repeated
    key only where ``keys`` names the column; for the others the plan stays advice.
    ``spellings`` are the learned ones of ``learn_spellings``, which ``clean`` has to be given
    too; without them categories are trimmed and upper-cased.  A FLAG_JOURNAL rule reads the mark ``_off_<column>`` of a
    ``Balance`` given to the engine.
    """
    rules: list[Rule] = []
    dropped: list[str] = []
    now = "localtimestamp()" if as_of is None else f"CAST('{as_of}' AS TIMESTAMP_NTZ)"
    for r in plan.orderBy("column_name", "action").collect():
        c, action, name = r["column_name"], r["action"], f"{r['rule']}_{r['column_name']}"
        q, flag = f"`{c}`", f"{c}_flag"
        median = Stat(f"{c}_median", "quantile", q)
        missing = f"{q} IS NULL"

        def impute(value: str, *stats: Stat) -> Rule:
            return Rule(name, "impute", action, c, when=missing, value=value, stats=stats)

        if action == "DROP_COLUMN":
            dropped.append(c)
            continue
        if action in ("DELETE_DUPLICATES", "DELETE_NULL_KEY") and c not in keys:
            continue
        detail = json.loads(r["detail"]) if r["detail"] else {}
        rules.append(
            {
                "DELETE_DUPLICATES": lambda: Rule(name, "key", action, c, keys=(c,)),
                "DELETE_NULL_KEY": lambda: Rule(name, "key", action, c, when=missing),
                "DELETE_NULL_TEMPORAL": lambda: Rule(name, "impossible", action, c, when=missing),
                "DELETE_FUTURE": lambda: Rule(name, "impossible", action, c, when=f"{q} > {now}"),
                "FLAG_NULL": lambda: Rule(
                    name, "flag", action, c, when=missing, flag=flag,
                    label="NULL_MONETARY" if r["column_class"] == "MONETARY" else "NULL_VALUE",
                ),
                "FLAG_FUTURE": lambda: Rule(
                    name, "flag", action, c, when=f"{q} > {now}", flag=flag, label="SCHEDULED"
                ),
                "CONVERT_TO_POSITIVE": lambda: Rule(
                    name, "money", action, c, when=f"{q} < 0", fn="abs", flag=flag, label="CONVERTED_NEGATIVE"
                ),
                "FLAG_NEGATIVE": lambda: Rule(
                    name, "money", action, c, when=f"{q} < 0", flag=flag, label="NEGATIVE_MONETARY"
                ),
                "FLAG_OUTLIER": lambda: Rule(
                    name, "money", action, c, when=f"{q} > {{{c}_p99}}", flag=flag,
                    label="POTENTIAL_ENTERPRISE_DEAL", stats=(Stat(f"{c}_p99", "quantile", q, 0.99),),
                ),
                "FLAG_DISTRIBUTION": lambda: Rule(
                    name, "flag", action, c, when=f"{q} IS NOT NULL", flag=f"{c}_review", label="DISTRIBUTION_REVIEW"
                ),
                "NULLIFY_MALFORMED": lambda: Rule(name, "text", action, c, fn="email"),
                "STANDARDIZE_PHONE": lambda: Rule(name, "text", action, c, fn="phone"),
                "TRIM_WHITESPACE": lambda: Rule(name, "text", action, c, fn="trim"),
                "STANDARDIZE": lambda: (
                    Rule(name, "text", action, c, value=f"coalesce(`{SPELLED.format(c)}`, {q})")
                    if spellings and c in spellings
                    else Rule(name, "text", action, c, fn="synonyms", args={"synonyms": {}})
                ),
                "DELETE_ROWS": lambda: Rule(name, "impossible", action, c, when=detail["when"]),
                "CAP_RANGE": lambda: Rule(
                    name, "bounds", action, c, when=detail["when"], value=detail["value"], flag=flag, label="CAPPED_RANGE"
                ),
                "RECOMPUTE": lambda: Rule(name, "logic", action, c, when=detail["when"], value=detail["value"]),
                "FLAG_PHYSICS": lambda: Rule(
                    name, "logic", action, c, when=detail["when"], flag=flag, label="PHYSICS_VIOLATION"
                ),
                "FLAG_ORPHAN": lambda: Rule(
                    name, "reference", action, c, when=detail["when"], flag=flag, label="ORPHANED_FK"
                ),
                "FLAG_JOURNAL": lambda: Rule(
                    name, "reference", action, c, when=f"_off_{c}", flag=f"{c}_flag", label="IMBALANCED_JOURNAL"
                ),
                "IMPUTE_MEDIAN": lambda: impute(f"{{{c}_median}}", median),
                "IMPUTE_MEAN": lambda: impute(f"{{{c}_mean}}", Stat(f"{c}_mean", "mean", q)),
                "IMPUTE_MODE": lambda: impute(
                    f"{{{c}_mode}}", Stat(f"{c}_mode", "mode", f"upper(regexp_replace({q}, '^\\\\s+|\\\\s+$', ''))")
                ),
                "IMPUTE_UNKNOWN": lambda: impute("'UNKNOWN'"),
                "IMPUTE_REGRESSION": lambda: impute(
                    f"coalesce({{{c}_slope}} * `{r['predictor']}` + {{{c}_intercept}}, {{{c}_median}})",
                    Stat(f"{c}_slope", "slope", q, other=f"`{r['predictor']}`"),
                    Stat(f"{c}_intercept", "intercept", q, other=f"`{r['predictor']}`"),
                    median,
                ),
                "CAP_P99": lambda: Rule(
                    name, "bounds", action, c, when=f"{q} > {{{c}_p99}}", value=f"{{{c}_p99}}", flag=flag,
                    label="CAPPED_P99", stats=(Stat(f"{c}_p99", "quantile", q, 0.99),),
                ),
            }[action]()
        )
    return rules, dropped


def schema_drift(df: DataFrame, catalog: DataFrame) -> DataFrame:
    """Columns added, removed or retyped against a stored catalog (column_name, data_type)."""
    current = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields], "column_name string, current_type string"
    )
    known = catalog.select("column_name", F.col("data_type").alias("catalog_type"))
    change = (
        F.when(F.col("catalog_type").isNull(), F.lit("ADDED"))
        .when(F.col("current_type").isNull(), F.lit("REMOVED"))
        .when(F.col("current_type") != F.col("catalog_type"), F.lit("RETYPED"))
    )
    return (
        current.join(known, "column_name", "full_outer")
        .withColumn("change", change)
        .filter(F.col("change").isNotNull())
    )
