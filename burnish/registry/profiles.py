"""Profiling queries (section C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnish.dirty import TABLES, table
from burnish.operators import profile as P
from burnish.operators import sketches as S
from burnish.operators.gram import correlation_matrix
from burnish.plans.decide import classify_columns
from burnish.registry.base import VIEW_NAMES, ctes, query, raw
from burnish.session import materialise

# Every column of the five views.
COLUMNS = {
    "orders": "row_seq order_id customer_id order_date order_amount total_amount status industry customer_name email nps_score "
    "health_score seats_used arr mrr onboarding_date go_live_date".split(),
    "telemetry": "row_seq device_id reading_timestamp ingestion_timestamp temperature_c humidity_pct pressure_psi device_status "
    "vibration_hz voltage_v current_a power_kw efficiency_pct predicted_failure_days torque_nm firmware_version device_type".split(),
    "workforce": "row_seq employee_id manager_id full_name email hire_date termination_date department employment_status base_salary "
    "bonus_target equity_grant total_comp salary_band_max perf_rating_2024 pto_days_used pto_days_remaining".split(),
    "ledger": "transaction_id journal_entry_id l_partkey l_suppkey l_quantity l_extendedprice posting_date effective_date approval_date "
    "debit_amount credit_amount net_amount currency fx_rate account_code approval_status vendor_id intercompany_flag".split(),
    "catalog": "row_seq product_id price_usd price_eur margin_pct stock_quantity weight_kg weight_lbs category_l1 description_en "
    "product_name_hi product_name_ja created_at published_at".split(),
}
NUMBERS = {
    "orders": ["order_amount", "total_amount", "nps_score", "health_score", "seats_used", "arr", "mrr"],
    "telemetry": ["temperature_c", "pressure_psi", "vibration_hz", "efficiency_pct", "predicted_failure_days", "torque_nm"],
    "workforce": ["base_salary", "bonus_target", "equity_grant", "total_comp"],
    "ledger": ["debit_amount", "credit_amount", "net_amount", "fx_rate"],
    "catalog": ["price_usd", "price_eur", "margin_pct", "weight_kg", "weight_lbs"],
}
# A column's type under its name in Spark.
TYPE = (
    "CASE WHEN typeof({c}) LIKE 'TIMESTAMP%' THEN 'timestamp_ntz' ELSE CASE typeof({c}) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' "
    "WHEN 'DOUBLE' THEN 'double' WHEN 'BIGINT' THEN 'bigint' WHEN 'DATE' THEN 'date' ELSE typeof({c}) END END"
)


def union(parts: list[str]) -> str:
    return " UNION ALL ".join(parts)


def profile_sql(name: str) -> str:
    return union(
        [
            f"SELECT '{c}' AS column_name, (SELECT {TYPE.format(c=c)} FROM dirty_{name} LIMIT 1) AS data_type, count(*) AS total_rows, "
            f"count(*) - count({c}) AS null_count, round((count(*) - count({c})) * 100 / count(*), 2) AS null_pct, "
            f"count(DISTINCT {c}) AS distinct_count FROM dirty_{name}"
            for c in COLUMNS[name]
        ]
    )


for _name in COLUMNS:
    query(f"c1_profile_columns_{_name}", ctes(f"dirty_{_name}") + profile_sql(_name))(
        lambda spark, sf_dir, name=_name: P.profile_columns(raw(spark, sf_dir, name))
    )


@query(
    "c2_profile_columns_approx",
    ctes("dirty_orders") + f"SELECT column_name, data_type, total_rows, null_count, null_pct, true AS distinct_close FROM ({profile_sql('orders')})",
)
def _approx(spark, sf_dir):
    """Sketched distinct counts within five percent of the exact ones."""
    df = raw(spark, sf_dir, "orders")
    exact = P.profile_columns(df).select("column_name", F.col("distinct_count").alias("exact"))
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * 0.05
    return P.profile_columns(df, approx=True).join(exact, "column_name").select(
        "column_name", "data_type", "total_rows", "null_count", "null_pct", close.alias("distinct_close")
    )


SKETCHED_NUMBERS = {"orders": ["row_seq", "customer_id", "order_amount", "total_amount", "nps_score", "health_score", "seats_used", "arr", "mrr"]}
SKETCHED_WORDS = {"orders": ["order_id", "status", "industry", "customer_name", "email"]}


def sketched_sql(view: str) -> str:
    """Exact counts, extremes of numbers and characters of texts per column, joined to the profile."""
    extremes = [f"SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS min_value, CAST(max({c}) AS DOUBLE) AS max_value, CAST(NULL AS BIGINT) AS text_chars FROM dirty_{view}" for c in SKETCHED_NUMBERS[view]]
    extremes += [f"SELECT '{c}', NULL, NULL, CAST(sum(length({c})) AS BIGINT) FROM dirty_{view}" for c in SKETCHED_WORDS[view]]
    return (
        "SELECT column_name, data_type, total_rows, null_count, null_pct, min_value, max_value, text_chars, true AS distinct_close "
        f"FROM ({profile_sql(view)}) LEFT JOIN ({union(extremes)}) USING (column_name)"
    )


@query("c2_profile_union", ctes("dirty_orders") + sketched_sql("orders"))
def _union(spark, sf_dir):
    """Sketches of ten parts, stored; the table's profile is made from them without its rows."""
    df = raw(spark, sf_dir, "orders")
    parts = materialise(S.column_sketches(df.withColumn("part", F.col("row_seq") % 10), by=["part"]), "sketches")
    exact = P.profile_columns(df).select("column_name", F.col("distinct_count").alias("exact"))
    done = S.sketched_profile(S.merge_sketches(parts)).join(exact, "column_name")
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * 0.05
    return done.select("column_name", "data_type", "total_rows", "null_count", "null_pct", "min_value", "max_value", "text_chars", close.alias("distinct_close"))


@query(
    "c3_column_ranges",
    ctes("dirty_ledger")
    + union(
        [
            f"SELECT '{c}' AS column_name, min(TRY_CAST({c} AS DOUBLE)) AS min_value, max(TRY_CAST({c} AS DOUBLE)) AS max_value, "
            f"count(TRY_CAST({c} AS DOUBLE)) AS numeric_values, count({c}) - count(TRY_CAST({c} AS DOUBLE)) AS text_values FROM dirty_ledger"
            for c in ["debit_amount", "net_amount", "account_code", "currency", "vendor_id"]
        ]
    ),
)
def _ranges(spark, sf_dir):
    return P.column_ranges(
        raw(spark, sf_dir, "ledger"), ["debit_amount", "net_amount", "account_code", "currency", "vendor_id"]
    )


@query(
    "c4_profile_metadata",
    ctes("dirty_orders")
    + "SELECT 'ORDERS' AS table_name, count(*) AS total_rows, least(count(*), 5000) AS sample_size, 'top_rows' AS sample_method FROM dirty_orders",
)
def _metadata(spark, sf_dir):
    return P.profile_metadata(raw(spark, sf_dir, "orders"), "ORDERS", "top_rows", 5000).drop("profiled_at")


@query(
    "c5_null_cells",
    ctes(*[f"dirty_{n}" for n in VIEW_NAMES])
    + union(
        [
            f"SELECT '{n}' AS table_name, count(*) * {len(COLUMNS[n])} AS total_cells, "
            + " + ".join(f"(count(*) - count({c}))" for c in COLUMNS[n])
            + " AS null_cells FROM dirty_"
            + n
            for n in VIEW_NAMES
        ]
    ),
)
def _null_cells(spark, sf_dir):
    pieces = [
        P.null_cells(raw(spark, sf_dir, n)).select(
            F.lit(n).alias("table_name"), "total_cells", "null_cells"
        )
        for n in VIEW_NAMES
    ]
    out = pieces[0]
    for p in pieces[1:]:
        out = out.unionByName(p)
    return out


def _per_column(name: str, view: str, fn, sql: str, digits: int = 6, value: str = "value") -> None:
    cols = NUMBERS[view]

    def run(spark, sf_dir):
        return fn(raw(spark, sf_dir, view), cols).select("column_name", F.round(value, digits).alias(value))

    query(
        name,
        ctes(f"dirty_{view}")
        + union([f"SELECT '{c}' AS column_name, round({sql.format(c=c)}, {digits}) AS {value} FROM dirty_{view}" for c in cols]),
    )(run)


_per_column("c6_col_mean", "orders", P.col_mean, "avg({c})", 4, "mean")
_per_column("c7_col_median", "orders", P.col_median, "median({c})", 4, "median")
_per_column("c8_col_quantile", "orders", lambda df, cols: P.col_quantile(df, cols, 0.99), "quantile_cont({c}, 0.99)", 4, "quantile")


@query(
    "c9_col_skewness",
    ctes("dirty_telemetry")
    + union(
        [
            f"SELECT '{c}' AS column_name, round((SELECT avg(power(t.{c} - m.a, 3)) / power(any_value(m.s), 3) FROM dirty_telemetry t, "
            f"(SELECT avg({c}) AS a, stddev_pop({c}) AS s FROM dirty_telemetry) m), 6) AS skewness"
            for c in NUMBERS["telemetry"]
        ]
    ),
)
def _skewness(spark, sf_dir):
    return P.col_skewness(raw(spark, sf_dir, "telemetry"), NUMBERS["telemetry"]).select(
        "column_name", F.round("skewness", 6).alias("skewness")
    )


@query(
    "c10_col_mode",
    ctes("dirty_ledger")
    + union(
        [
            f"(SELECT '{c}' AS column_name, {c} AS mode, count(*) AS rows FROM dirty_ledger WHERE {c} IS NOT NULL "
            f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
            for c in ["currency", "approval_status", "account_code"]
        ]
    ),
)
def _mode(spark, sf_dir):
    return P.col_mode(raw(spark, sf_dir, "ledger"), ["currency", "approval_status", "account_code"])


_TIED = "SELECT CAST(9 + k AS {long}) AS number, CAST(9 + k AS {text}) AS word FROM (SELECT o_orderkey % 2 AS k FROM orders UNION ALL SELECT 1 - o_orderkey % 2 FROM orders)"


@query(
    "c10_col_mode_ties",
    union(
        [
            f"(SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS mode, count(*) AS rows FROM ({_TIED.format(long='BIGINT', text='VARCHAR')}) "
            f"GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
            for c in ("number", "word")
        ]
    ),
)
def _mode_ties(spark, sf_dir):
    """Two values equally often: 9 before 10 as numbers, "10" before "9" as text."""
    text = _TIED.format(long="BIGINT", text="STRING").replace("FROM orders", "FROM {orders}")
    return P.col_mode(spark.sql(text, orders=table(spark, sf_dir, "orders")), ["number", "word"])


PAIRS = [("arr", "mrr"), ("order_amount", "total_amount"), ("nps_score", "health_score"), ("arr", "seats_used")]


@query(
    "c11_correlations",
    ctes("dirty_orders")
    + union(
        [
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, round(corr({a}, {b}), 6) AS r FROM dirty_orders"
            for a, b in PAIRS
        ]
    ),
)
def _correlations(spark, sf_dir):
    return P.correlations(raw(spark, sf_dir, "orders"), PAIRS).withColumn("r", F.round("r", 6))


_EVERY = SKETCHED_NUMBERS["orders"]


@query(
    "c11_correlation_matrix",
    ctes("dirty_orders")
    + union(
        [
            f"SELECT '{a}' AS column_a, '{b}' AS column_b, count(*) FILTER ({a} IS NOT NULL AND {b} IS NOT NULL) AS rows, round(corr({a}, {b}), 6) AS r FROM dirty_orders"
            for i, a in enumerate(_EVERY)
            for b in _EVERY[i + 1 :]
        ]
    ),
)
def _matrix(spark, sf_dir):
    """Every pair of number columns from one scan."""
    return correlation_matrix(raw(spark, sf_dir, "orders"), _EVERY).withColumn("r", F.round("r", 6))


@query(
    "c12_outlier_rate",
    ctes("dirty_orders")
    + union(
        [
            f"SELECT '{c}' AS column_name, round(any_value(b), 4) AS bound, CAST(count(*) FILTER ({c} > b) AS BIGINT) AS outliers, "
            f"round(count(*) FILTER ({c} > b) * 100 / count({c}), 6) AS outlier_pct FROM dirty_orders, "
            f"(SELECT quantile_cont({c}, 0.75) + 3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) AS b FROM dirty_orders)"
            for c in ["total_amount", "arr", "seats_used"]
        ]
    ),
)
def _outliers(spark, sf_dir):
    return P.outlier_rate(raw(spark, sf_dir, "orders"), ["total_amount", "arr", "seats_used"]).select(
        "column_name", F.round("bound", 4).alias("bound"), "outliers", F.round("outlier_pct", 6).alias("outlier_pct")
    )


@query(
    "c13_value_list",
    ctes("dirty_workforce")
    + "SELECT array_to_string(list(department ORDER BY department), '|') AS department_values FROM "
    "(SELECT DISTINCT department FROM dirty_workforce WHERE department IS NOT NULL ORDER BY department LIMIT 6)",
)
def _value_list(spark, sf_dir):
    return P.value_list(raw(spark, sf_dir, "workforce"), "department", 6).select(
        F.array_join("value_list", "|").alias("department_values")
    )


@query(
    "c14_value_counts",
    ctes("dirty_workforce")
    + "SELECT department, count(*) AS cnt FROM dirty_workforce GROUP BY department ORDER BY cnt DESC, department LIMIT 10",
)
def _value_counts(spark, sf_dir):
    return P.value_counts(raw(spark, sf_dir, "workforce"), "department", 10)


@query(
    "c15_variant_clusters",
    ctes("dirty_orders")
    + "SELECT upper(trim(status)) AS cluster, arg_max(status, (n, status)) AS canonical, count(*) AS variants, "
    "CAST(sum(n) AS BIGINT) AS rows FROM (SELECT status, count(*) AS n FROM dirty_orders GROUP BY status) GROUP BY 1",
)
def _variants(spark, sf_dir):
    return P.variant_clusters(raw(spark, sf_dir, "orders"), "status")


CLASSES = {
    "order_date": "TEMPORAL", "go_live_date": "TEMPORAL", "order_amount": "MONETARY", "arr": "MONETARY", "nps_score": "NUMERIC",
    "seats_used": "NUMERIC", "status": "CATEGORY", "industry": "CATEGORY", "customer_name": "PII", "email": "PII",
}


@query(
    "c16_classify_columns",
    ctes("dirty_orders")
    + union(
        [f"SELECT '{c}' AS column_name, '{k}' AS column_class" for c, k in CLASSES.items()]
        + [
            f"SELECT '{c}', CASE WHEN count(DISTINCT {c}) / count({c}) >= 9e-1 THEN 'NUMERIC_PK' ELSE 'REFERENCE' END FROM dirty_orders"
            for c in ("row_seq", "order_id", "customer_id")
        ]
    ),
)
def _classify(spark, sf_dir):
    df = raw(spark, sf_dir, "orders").select("row_seq", "order_id", "customer_id", *CLASSES)
    return classify_columns(P.profile_columns(df)).select("column_name", "column_class")


CONSTRAINTS = {
    "salary_above_band": "base_salary > salary_band_max",
    "comp_below_salary": "total_comp < base_salary",
    "leave_overdrawn": "pto_days_remaining < 0",
    "low_rating_high_bonus": "perf_rating_2024 <= 1 AND bonus_target > 6000",
}


@query(
    "c17_contradictions",
    ctes("dirty_workforce")
    + union(
        [
            f"SELECT '{k}' AS constraint_name, count(*) FILTER ({e}) AS violations, "
            f"round(count(*) FILTER ({e}) * 100 / count(*), 6) AS violation_pct FROM dirty_workforce"
            for k, e in CONSTRAINTS.items()
        ]
    ),
)
def _contradictions(spark, sf_dir):
    return P.contradictions(raw(spark, sf_dir, "workforce"), CONSTRAINTS).withColumn(
        "violation_pct", F.round("violation_pct", 6)
    )


@query(
    "c18_numeric_summary",
    ctes("dirty_ledger")
    + union(
        [
            f"SELECT '{c}' AS column_name, count({c}) AS count_values, round(sum({c}), 2) AS sum_value, round(avg({c}), 4) AS avg_value, "
            f"min({c}) AS min_value, max({c}) AS max_value FROM dirty_ledger"
            for c in NUMBERS["ledger"]
        ]
    ),
)
def _summary(spark, sf_dir):
    return P.numeric_summary(raw(spark, sf_dir, "ledger"), NUMBERS["ledger"]).select(
        "column_name",
        "count_values",
        F.round("sum_value", 2).alias("sum_value"),
        F.round("avg_value", 4).alias("avg_value"),
        "min_value",
        "max_value",
    )


GROUPS = {
    "order_id": "identity", "customer_id": "identity", "customer_name": "person", "email": "person",
    "status": "category", "industry": "category",
}


@query(
    "c19_null_rate_by_group",
    ctes("dirty_orders")
    + "SELECT column_group, count(*) AS columns, round(avg(null_pct), 4) AS avg_null_pct FROM ("
    + union(
        [
            f"SELECT '{g}' AS column_group, round((count(*) - count({c})) * 100 / count(*), 2) AS null_pct FROM dirty_orders"
            for c, g in GROUPS.items()
        ]
    )
    + ") GROUP BY column_group",
)
def _by_group(spark, sf_dir):
    profile = P.profile_columns(raw(spark, sf_dir, "orders"), list(GROUPS))
    return P.null_rate_by_group(profile, GROUPS).withColumn("avg_null_pct", F.round("avg_null_pct", 4))


@query(
    "a16_count_shape",
    union(
        [
            f"SELECT '{t}' AS table_name, count(*) AS row_count, "
            f"(SELECT count(*) FROM (DESCRIBE SELECT * FROM {t})) AS column_count FROM {t}"
            for t in TABLES
        ]
    ),
)
def _shape(spark, sf_dir):
    out = None
    for t in TABLES:
        piece = P.count_shape(table(spark, sf_dir, t)).select(F.lit(t).alias("table_name"), "*")
        out = piece if out is None else out.unionByName(piece)
    return out
