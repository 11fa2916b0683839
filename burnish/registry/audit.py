"""Audit and comparison queries (section H)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.operators import compare as C
from burnish.plans.engine import audit_totals, clean, surviving_rows
from burnish.plans.prepare import prepare
from burnish.plans.rules import Rule
from burnish.registry import scores
from burnish.registry.base import (
    APPROVAL,
    AS_OF,
    AS_OF_EVENTS,
    CATEGORY,
    CODE,
    DEPARTMENT,
    DEVICE,
    EMAIL,
    EMPLOYMENT,
    FIRMWARE,
    INDUSTRY,
    NET,
    NOT_HINDI,
    NOT_JAPANESE,
    STATUS,
    STRIPPED,
    VIEW_NAMES,
    ctes,
    define,
    domain,
    layers,
    query,
    raw,
)
from burnish.registry.detection import issues_sql
from burnish.registry.profiles import COLUMNS, union
from burnish.session import materialise
from burnish.sources import load as L
from burnish.sources.typing import cast_or_reject

# (rule, action, column, rows matched, cells modified) over the surviving rows.
_RULES = [
    ("SCHEDULED_order_date", "FLAG_FUTURE", "order_date", f"order_date > TIMESTAMP '{AS_OF}'", "false"),
    ("MONETARY_NULL", "FLAG_NULL", "order_amount", "order_amount IS NULL", "false"),
    ("MONETARY_NEGATIVE", "CONVERT_TO_POSITIVE", "order_amount", "order_amount < 0", "order_amount < 0"),
    ("MONETARY_OUTLIER", "FLAG", "total_amount", "total_amount > p99", "false"),
    ("PII_CLEANUP", "TRIM_WHITESPACE", "customer_name", "customer_name <> trim(customer_name)", None),
    ("PII_EMAIL", "NULLIFY_MALFORMED", "email", f"NOT {EMAIL} OR email <> lower(email)", None),
    ("NUMERIC_NEGATIVE", "SET_ZERO", "seats_used", "seats_used < 0", None),
    ("CATEGORY_CONSISTENCY", "STANDARDIZE", "status", f"status <> {STATUS}", None),
    ("CATEGORY_SYNONYMS", "STANDARDIZE", "industry", f"industry <> {INDUSTRY}", None),
    ("NULL_nps_score", "IMPUTE_MEDIAN", "nps_score", "nps_score IS NULL", None),
    ("NULL_health_score", "IMPUTE_MEAN", "health_score", "health_score IS NULL", None),
    ("LOGIC_VIOLATION", "RECOMPUTE", "arr", "arr < mrr * 12 * (1 - 1e-9)", None),
    ("FK_VIOLATION", "FLAG", "customer_id", "customer_id >= 1000000000", "false"),
]
_AUDIT = [
    "SELECT 'DELETE_DUPLICATES' AS action, 'order_id' AS column_name, 'PK_VIOLATION' AS rule, count(*) - count(DISTINCT order_id) AS rows_matched, "
    "count(*) - count(DISTINCT order_id) AS rows_deleted, CAST(0 AS BIGINT) AS cells_modified FROM dirty_orders",
    "SELECT 'DELETE_ROWS', 'onboarding_date/go_live_date', 'IMPOSSIBLE_SEQUENCE', count(*) FILTER (onboarding_date > go_live_date), "
    "count(*) FILTER (onboarding_date > go_live_date), 0 FROM orders_first",
] + [
    f"SELECT '{a}', '{c}', '{n}', count(*) FILTER ({w}), 0, count(*) FILTER ({w if m is None else m}) FROM orders_live, orders_stat"
    for n, a, c, w, m in _RULES
]
define("audit_orders", union(_AUDIT), "dirty_orders", "orders_first", "orders_live", "orders_stat")


@query("h1_audit", ctes("audit_orders") + "SELECT * FROM audit_orders")
def _audit(spark, sf_dir):
    return domain("orders").clean(raw(spark, sf_dir, "orders")).audit().drop("position")


# The other tables' rules over their surviving rows: (rule, action, column, rows matched, cells modified or None for the same).
_NO = "false"
_OTHER_RULES = {
    "telemetry": [
        ("CLOCK_DRIFT_reading_timestamp", "FLAG_FUTURE", "reading_timestamp", f"reading_timestamp > TIMESTAMP '{AS_OF_EVENTS}'", _NO),
        ("SENSOR_RANGE", "FLAG", "temperature_c", "temperature_c > 500 OR temperature_c < -50", _NO),
        ("IMPOSSIBLE_VALUE", "NULLIFY_NEGATIVE", "pressure_psi", "pressure_psi < 0", None),
        ("PHYSICAL_LIMIT", "CAP", "efficiency_pct", "efficiency_pct > 100", None),
        ("ZERO_WHILE_RUNNING", "FLAG", "vibration_hz", "vibration_hz = 0 AND device_status = 'running'", _NO),
        ("PHYSICS", "FLAG", "power_kw", "power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9)", _NO),
        ("NULL_predicted_failure_days", "IMPUTE_MEDIAN", "predicted_failure_days", "predicted_failure_days IS NULL", None),
        ("NULL_torque_nm", "IMPUTE_MEDIAN", "torque_nm", "torque_nm IS NULL", None),
        ("FORMAT_CONSISTENCY", "STANDARDIZE", "firmware_version", f"firmware_version <> {FIRMWARE}", None),
        ("CATEGORY_CONSISTENCY", "STANDARDIZE", "device_type", f"device_type <> {DEVICE}", None),
    ],
    "workforce": [
        ("FUTURE_DATE_ERROR_hire_date", "FLAG_FUTURE", "hire_date", f"hire_date > TIMESTAMP '{AS_OF}'", _NO),
        ("MONETARY_NEGATIVE", "CONVERT_TO_POSITIVE", "base_salary", "base_salary < 0", None),
        ("TOTAL_COMP", "RECOMPUTE", "total_comp", "total_comp < abs(base_salary)", None),
        ("PRESERVE_NULL", "PRESERVE", "bonus_target", "bonus_target IS NULL", _NO),
        ("PII_CLEANUP", "TRIM_WHITESPACE", "full_name", "full_name <> trim(full_name)", None),
        ("PII_EMAIL", "NULLIFY_MALFORMED", "email", f"NOT {EMAIL} OR email <> lower(email)", None),
        ("CATEGORY_CONSISTENCY", "STANDARDIZE", "department", f"department <> {DEPARTMENT}", None),
        ("CATEGORY_CONSISTENCY", "STANDARDIZE", "employment_status", f"employment_status <> {EMPLOYMENT}", None),
        ("RATING_RANGE", "MEDIAN_IF_OUT_OF_RANGE", "perf_rating_2024", "perf_rating_2024 < 1 OR perf_rating_2024 > 5", None),
        ("LEAVE_BALANCE", "CAP_BALANCE", "pto_days_used", "pto_days_used > pto_days_used + pto_days_remaining", None),
        ("FK_VIOLATION", "FLAG", "manager_id", "manager_id IS NOT NULL AND manager_id NOT IN (SELECT employee_id FROM workforce_live)", _NO),
        ("SALARY_BAND", "FLAG", "salary_band_max", "abs(base_salary) > salary_band_max", _NO),
    ],
    "ledger": [
        ("MONETARY_NEGATIVE", "CONVERT_TO_POSITIVE", "debit_amount", "debit_amount < 0", None),
        ("LOGIC_VIOLATION", "RECOMPUTE", "net_amount", "abs(net_amount - (abs(debit_amount) - credit_amount)) > 1e-2", None),
        ("PRECISION_2DP", "ROUND_2DP", "debit_amount", "abs(debit_amount) IS DISTINCT FROM debit2", None),
        ("PRECISION_2DP", "ROUND_2DP", "credit_amount", "credit_amount IS DISTINCT FROM credit2", None),
        ("PRECISION_2DP", "ROUND_2DP", "net_amount", f"{NET} IS DISTINCT FROM net2", None),
        ("FUTURE_DATE_posting_date", "FLAG_FUTURE", "posting_date", f"posting_date > TIMESTAMP '{AS_OF}'", _NO),
        ("LAG", "FLAG", "effective_date", "date_sub('day', effective_date, posting_date) > 365", _NO),
        ("APPROVAL_ORDER", "FLAG", "approval_date", "approval_date < posting_date", _NO),
        *[
            ("GROUPED_IMPUTATION", "IMPUTE_MEDIAN_BY_GROUP", "fx_rate", f"fx_rate IS NULL AND currency = '{c}'", None)
            for c in ("EUR", "GBP", "JPY", "INR", "CAD", "AUD")
        ],
        ("FORMAT_STANDARDISE", "STANDARDIZE", "account_code", f"account_code <> {CODE}", None),
        ("CATEGORY_CONSISTENCY", "STANDARDIZE", "approval_status", f"approval_status <> {APPROVAL}", None),
        ("FK_VIOLATION", "FLAG", "vendor_id", "vendor_id >= 1000000000", _NO),
        ("JOURNAL_BALANCE", "FLAG", "journal_entry_id", "off_all", _NO),
        ("INTERCOMPANY", "FLAG", "intercompany_flag", "off_ic AND intercompany_flag = 1", _NO),
    ],
    "catalog": [
        ("MONETARY_NULL", "FLAG_NULL", "price_usd", "price_usd IS NULL", _NO),
        ("MONETARY_NEGATIVE", "CONVERT_TO_POSITIVE", "price_usd", "price_usd < 0", None),
        ("CAP_RANGE", "CAP_RANGE", "margin_pct", "margin_pct < -50 OR margin_pct > 100", None),
        ("NUMERIC_NEGATIVE", "SET_ZERO", "stock_quantity", "stock_quantity < 0", None),
        ("CATEGORY_CONSISTENCY", "STANDARDIZE", "category_l1", f"category_l1 <> {CATEGORY}", None),
        ("STRIP_HTML", "STRIP_HTML", "description_en", f"description_en <> {STRIPPED}", None),
        ("WRONG_LANGUAGE", "FLAG", "product_name_hi", NOT_HINDI, _NO),
        ("WRONG_LANGUAGE", "FLAG", "product_name_ja", NOT_JAPANESE, _NO),
        ("NULL_product_name_hi", "IMPUTE_UNKNOWN", "product_name_hi", "product_name_hi IS NULL", None),
        ("NULL_product_name_ja", "IMPUTE_UNKNOWN", "product_name_ja", "product_name_ja IS NULL", None),
        ("UNIT_WEIGHT", "RECOMPUTE", "weight_lbs", "abs(weight_lbs - weight_kg * 2205e-3) > 1e-2", None),
        ("STALE_FX", "FLAG", "price_eur", "abs(price_eur - abs(price_usd) * 92e-2) > 1e-2", _NO),
    ],
}
_SEQUENCES = {
    "telemetry": ("reading_timestamp", "ingestion_timestamp"),
    "workforce": ("hire_date", "termination_date"),
    "catalog": ("created_at", "published_at"),
}


def _audit_sql(name: str) -> str:
    keys = scores.KEY_COLUMNS[name]
    live = "ledger_money JOIN ledger_off ON journal_entry_id = je" if name == "ledger" else f"{name}_live"
    copies = f"(SELECT CAST(sum(n - 1) AS BIGINT) FROM (SELECT count(*) AS n FROM dirty_{name} GROUP BY {keys}))"
    parts = [
        f"SELECT 'DELETE_DUPLICATES' AS action, '{keys.replace(', ', ',')}' AS column_name, 'PK_VIOLATION' AS rule, {copies} AS rows_matched, "
        f"{copies} AS rows_deleted, CAST(0 AS BIGINT) AS cells_modified, '{name}' AS table_name"
    ]
    if name in _SEQUENCES:
        a, b = _SEQUENCES[name]
        parts.append(
            f"SELECT 'DELETE_ROWS', '{a}/{b}', 'IMPOSSIBLE_SEQUENCE', count(*) FILTER ({a} > {b}), count(*) FILTER ({a} > {b}), 0, '{name}' FROM {name}_first"
        )
    parts += [
        f"SELECT '{a}', '{c}', '{n}', count(*) FILTER ({w}), 0, count(*) FILTER ({w if m is None else m}), '{name}' FROM {live}"
        for n, a, c, w, m in _OTHER_RULES[name]
    ]
    return union(parts)


_AUDITED = ("telemetry_live", "telemetry_first", "workforce_live", "workforce_first", "ledger_money", "ledger_off", "catalog_live", "catalog_first")


@query(
    "h1_audit_all",
    ctes("audit_orders", *[f"dirty_{n}" for n in _OTHER_RULES], *_AUDITED)
    + union([*[_audit_sql(n) for n in _OTHER_RULES], "SELECT *, 'orders' FROM audit_orders"]),
)
def _audit_all(spark, sf_dir):
    out = None
    for name in VIEW_NAMES:
        piece = domain(name).clean(raw(spark, sf_dir, name)).audit().drop("position").withColumn("table_name", F.lit(name))
        out = piece if out is None else out.unionByName(piece)
    return out


@query(
    "h2_audit_totals",
    ctes("audit_orders")
    + "SELECT CAST(sum(rows_deleted) AS BIGINT) AS rows_deleted, CAST(sum(cells_modified) AS BIGINT) AS rows_modified FROM audit_orders",
)
def _totals(spark, sf_dir):
    return audit_totals(domain("orders").clean(raw(spark, sf_dir, "orders")).audit())


@query(
    "h3_removed_rows",
    ctes("orders_first")
    + "SELECT row_seq, order_id, 'PK_VIOLATION' AS reason FROM dirty_orders WHERE row_seq NOT IN (SELECT row_seq FROM orders_first) "
    "UNION ALL SELECT row_seq, order_id, 'IMPOSSIBLE_SEQUENCE' FROM orders_first WHERE onboarding_date > go_live_date",
)
def _removed(spark, sf_dir):
    return domain("orders").clean(raw(spark, sf_dir, "orders")).removed_rows().select("row_seq", "order_id", "reason")


@query(
    "h3_removed_rows_ties",
    ctes("dirty_orders")
    + "SELECT industry, status, 'PK_VIOLATION' AS reason FROM dirty_orders "
    "QUALIFY row_number() OVER (PARTITION BY industry ORDER BY status) > 1",
)
def _removed_ties(spark, sf_dir):
    """Rows that tie in the order are exact copies here; all but the kept one are listed."""
    df = raw(spark, sf_dir, "orders").select("industry", "status")
    rule = Rule("PK_VIOLATION", "key", "DELETE_DUPLICATES", "industry", keys=("industry",))
    return clean(df, [rule], ["status"]).removed_rows()


# How a compared value is printed in either engine.
_MOMENTS = ("order_date", "onboarding_date", "go_live_date")
_DAYS = ("created_at", "published_at")
_PLAIN = (
    "order_id", "customer_id", "status", "industry", "customer_name", "email", "product_id", "category_l1", "description_en",
    "product_name_hi", "product_name_ja",
)


def printed(value: Column, kind: T.DataType) -> Column:
    """Six places for numbers, seconds for moments."""
    if isinstance(kind, T.DoubleType):
        return value.cast("decimal(24,6)").cast("string")
    if isinstance(kind, T.TimestampNTZType):
        return F.date_format(value, "yyyy-MM-dd HH:mm:ss")
    return value.cast("string")


def _printed_sql(value: str, column: str) -> str:
    if column in _MOMENTS:
        return f"strftime({value}, '%Y-%m-%d %H:%M:%S')"
    if column in _PLAIN or column in _DAYS:
        return f"CAST({value} AS VARCHAR)"
    return f"CAST(CAST({value} AS DECIMAL(24, 6)) AS VARCHAR)"


def _diff_sql(name: str, key: str = "row_seq") -> str:
    """Cell changes of the first raw row of each key, and every raw row without a cleaned one."""
    cols = [c for c in COLUMNS[name] if c not in (key, "row_seq")]
    first = f"(SELECT * FROM dirty_{name} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY row_seq) = 1)"

    def kind(c: str) -> str:
        return f"CASE WHEN r.{c} IS NULL THEN 'FILLED' WHEN k.{c} IS NULL THEN 'NULLED' ELSE 'CHANGED' END"

    cells = [
        f"SELECT r.{key}, '{c}' AS column_name, {_printed_sql(f'r.{c}', c)} AS raw_value, {_printed_sql(f'k.{c}', c)} AS cleaned_value, "
        f"{kind(c)} AS change_type FROM {first} r JOIN clean_{name} k USING ({key}) WHERE r.{c} IS DISTINCT FROM k.{c}"
        for c in cols
    ]
    gone = f"SELECT r.{key}, NULL, NULL, NULL, 'ROW_DELETED' FROM {first} r WHERE r.{key} NOT IN (SELECT {key} FROM clean_{name})"
    copies = f"SELECT {key}, NULL, NULL, NULL, 'ROW_DELETED' FROM dirty_{name} QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY row_seq) > 1"
    return union([*cells, gone, copies])


define("order_diff", _diff_sql("orders"), "dirty_orders", "clean_orders")
define("order_diff_by_id", _diff_sql("orders", "order_id"), "dirty_orders", "clean_orders")
define("catalog_diff", _diff_sql("catalog"), "dirty_catalog", "clean_catalog")


def _diff(spark, sf_dir, name: str = "orders", key: str = "row_seq"):
    both = layers(spark, sf_dir, name)
    cols = [c for c in COLUMNS[name] if c not in (key, "row_seq")]
    return C.cell_diff(both["RAW"], both["CLEANED"], [key], cols, ["row_seq"], printed)


@query(
    "h4_recompute_log",
    ctes("order_diff")
    + "SELECT row_seq, column_name, raw_value, cleaned_value FROM order_diff WHERE column_name = 'arr' AND change_type = 'CHANGED'",
)
def _recomputed(spark, sf_dir):
    return C.recompute_log(_diff(spark, sf_dir), ["arr"])


for _id, _name, _key, _view in (
    ("h5_cell_diff", "orders", "row_seq", "order_diff"),
    ("h5_cell_diff_by_order_id", "orders", "order_id", "order_diff_by_id"),
    ("h5_cell_diff_catalog", "catalog", "row_seq", "catalog_diff"),
):
    query(_id, ctes(_view) + f"SELECT * FROM {_view}")(
        lambda spark, sf_dir, name=_name, key=_key: _diff(spark, sf_dir, name, key)
    )


@query(
    "h6_diff_sample",
    ctes("order_diff")
    + ", top AS (SELECT column_name FROM order_diff WHERE column_name IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 10), "
    "picked AS (SELECT * FROM order_diff WHERE column_name IN (SELECT column_name FROM top)) "
    "SELECT * FROM picked WHERE row_seq IN (SELECT DISTINCT row_seq FROM picked ORDER BY row_seq LIMIT 20)",
)
def _sample(spark, sf_dir):
    return C.diff_sample(_diff(spark, sf_dir), ["row_seq"], 10, 20)


def _metric_sql(name: str, exprs: dict[str, str]) -> str:
    cols = ", ".join(f"{e} AS {a}" for a, e in exprs.items())
    return ctes(f"dirty_{name}", f"clean_{name}") + union(
        [f"SELECT '{layer}' AS layer, {cols} FROM {t}" for layer, t in (("RAW", f"dirty_{name}"), ("CLEANED", f"clean_{name}"))]
    )


def _metrics(ident: str, name: str, exprs: dict[str, str], sql: dict[str, str] | None = None) -> None:
    @query(ident, _metric_sql(name, sql or exprs))
    def _run(spark, sf_dir):
        return C.compare_metrics(layers(spark, sf_dir, name), [F.expr(e).alias(a) for a, e in exprs.items()])


_metrics(
    "h7_compare_metrics_nulls", "orders",
    {
        "total": "count(*)",
        "null_order_amount": "count(*) - count(order_amount)",
        "null_customer_name": "count(*) - count(customer_name)",
        "null_email": "count(*) - count(email)",
    },
)
_metrics(
    "h7_compare_metrics_ranges", "telemetry",
    {
        "min_temp": "min(temperature_c)",
        "max_temp": "max(temperature_c)",
        "min_hum": "min(humidity_pct)",
        "max_hum": "max(humidity_pct)",
    },
)
_metrics(
    "h7_compare_metrics_sums", "ledger",
    {
        "total_txns": "count(*)",
        "total_amount": "round(sum(debit_amount), 2)",
        "avg_amount": "round(avg(debit_amount), 4)",
        "min_amount": "min(debit_amount)",
        "max_amount": "max(debit_amount)",
    },
)


def _distribution(ident: str, name: str, column: str, n: int | None) -> None:
    order = "" if n is None else f" ORDER BY cnt DESC, {column} NULLS LAST LIMIT {n}"
    parts = [
        f"(SELECT '{layer}' AS layer, {column}, count(*) AS cnt FROM {t} GROUP BY {column}{order})"
        for layer, t in (("RAW", f"dirty_{name}"), ("CLEANED", f"clean_{name}"))
    ]

    @query(ident, ctes(f"dirty_{name}", f"clean_{name}") + union(parts))
    def _run(spark, sf_dir):
        return C.compare_distribution(layers(spark, sf_dir, name), column, n)


_distribution("h8_compare_distribution_status", "orders", "status", None)
_distribution("h8_compare_distribution_department", "workforce", "department", 10)


@query(
    "h8_compare_distribution_category",
    ctes("dirty_catalog", "clean_catalog")
    + union(
        [
            f"(SELECT '{layer}' AS layer, category_l1, count(*) AS product_count, round(avg(price_usd), 4) AS avg_price FROM {t} "
            "GROUP BY category_l1 ORDER BY product_count DESC, category_l1 LIMIT 10)"
            for layer, t in (("RAW", "dirty_catalog"), ("CLEANED", "clean_catalog"))
        ]
    ),
)
def _categories(spark, sf_dir):
    out = None
    for layer, df in layers(spark, sf_dir, "catalog").items():
        counts = df.groupBy("category_l1").agg(
            F.count(F.lit(1)).alias("product_count"), F.round(F.avg("price_usd"), 4).alias("avg_price")
        )
        piece = counts.orderBy(F.desc("product_count"), "category_l1").limit(10).withColumn("layer", F.lit(layer))
        out = piece if out is None else out.unionByName(piece)
    return out


_COUNTS = [
    (f"{n.upper()}_{layer}", layer, t)
    for n in VIEW_NAMES
    for layer, t in (("RAW", f"dirty_{n}"), ("CLEANED", f"clean_{n}"))
]
define(
    "loaded",
    union([f"SELECT '{layer}' AS table_schema, '{name}' AS table_name, count(*) AS row_count FROM {t}" for name, layer, t in _COUNTS]),
    *[t for *_, t in _COUNTS],
)


def _loaded(spark, sf_dir):
    """Row counts of both layers; only key columns of the cleaning are computed."""
    tables = {}
    for name in VIEW_NAMES:
        df = raw(spark, sf_dir, name)
        tables[("RAW", f"{name.upper()}_RAW")] = df
        d = domain(name)
        tables[("CLEANED", f"{name.upper()}_CLEANED")] = surviving_rows(df, d.rules, list(d.order_by))[1]
    return C.layer_counts(tables)


@query(
    "h9_layer_summary",
    ctes("loaded")
    + "SELECT r.table_name AS raw_table, r.row_count AS raw_rows, c.table_name AS cleaned_table, c.row_count AS cleaned_rows, "
    "r.row_count - c.row_count AS rows_removed, round((r.row_count - c.row_count) / r.row_count * 100, 2) AS pct_removed "
    "FROM loaded r JOIN loaded c ON replace(r.table_name, '_RAW', '') = replace(c.table_name, '_CLEANED', '') "
    "WHERE r.table_schema = 'RAW' AND c.table_schema = 'CLEANED'",
)
def _summary(spark, sf_dir):
    return C.layer_summary(_loaded(spark, sf_dir))


def _scored(layer: str, column: str) -> str:
    return f"(SELECT {column} FROM scores_orders WHERE layer = '{layer}')"


def _issues(severity: str) -> str:
    return f"(SELECT CAST(coalesce(sum(issue_rows), 0) AS BIGINT) FROM ({issues_sql('dirty_orders')}) WHERE severity = '{severity}')"


@query(
    "h10_report_row",
    ctes("scores_orders", "audit_orders")
    + f"SELECT 'orders' AS table_name, {_scored('raw', 'total_rows')} AS raw_rows, {_scored('cleaned', 'total_rows')} AS cleaned_rows, "
    "(SELECT CAST(sum(rows_deleted) AS BIGINT) FROM audit_orders) AS rows_deleted, (SELECT CAST(sum(cells_modified) AS BIGINT) FROM audit_orders) AS rows_modified, "
    f"{_scored('raw', 'overall')} AS quality_score_raw, {_scored('cleaned', 'overall')} AS quality_score_clean, "
    f"{_scored('raw', 'grade')} AS grade_raw, {_scored('cleaned', 'grade')} AS grade_clean, "
    f"{_issues('CRITICAL')} AS issues_critical, {_issues('WARNING')} AS issues_warning",
)
def _report(spark, sf_dir):
    """The report row but for its time stamps and the nested document."""
    row = prepare(raw(spark, sf_dir, "orders"), domain("orders")).report(AS_OF)
    return row.drop("profiled_at", "created_at", "full_profile_json")


def _stored_report(spark, sf_dir):
    """The report row of the orders, stored with its document as VARIANT and read back."""
    return materialise(L.as_variant(prepare(raw(spark, sf_dir, "orders"), domain("orders")).report(AS_OF)), "report")


@query(
    "h10_report_paths",
    ctes("scores_orders", "audit_orders")
    + f"SELECT 'orders' AS table_name, {_scored('raw', 'total_rows')} AS total_rows, 'row_seq' AS last_column, CAST(NULL AS VARCHAR) AS nowhere",
)
def _report_paths(spark, sf_dir):
    """Single values of the nested document by path; the last of the sorted column profiles by its place."""
    paths = {
        "total_rows": ("$.profile_metadata.total_rows", "bigint"),
        "last_column": (f"$.column_profiles[{sorted(COLUMNS['orders']).index('row_seq')}].column_name", "string"),
        "nowhere": ("$.profile_metadata.nowhere", "string"),
    }
    return _stored_report(spark, sf_dir).select("table_name", *L.document_values(paths))


@query(
    "h10_report_scores",
    ctes("scores_orders")
    + f"SELECT 'orders' AS table_name, 'overall' AS dimension, {_scored('raw', 'overall')} AS before_score, {_scored('cleaned', 'overall')} AS after_score",
)
def _report_scores(spark, sf_dir):
    """Overall scores before and after out of the stored document."""
    fields = {"dimension": ("$.dimension", "string"), "before_score": ("$.before_score", "double"), "after_score": ("$.after_score", "double")}
    return L.document_rows(_stored_report(spark, sf_dir), "$.pre_post_comparison", fields).filter("dimension = 'overall'")


@query(
    "h10_report_columns",
    ctes("dirty_orders")
    + union([f"SELECT 'orders' AS table_name, '{c}' AS column_name, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count FROM dirty_orders" for c in COLUMNS["orders"]]),
)
def _report_columns(spark, sf_dir):
    """The column profiles of the stored document, one row each."""
    fields = {"column_name": ("$.column_name", "string"), "null_count": ("$.null_count", "bigint"), "distinct_count": ("$.distinct_count", "bigint")}
    return L.document_rows(_stored_report(spark, sf_dir), "$.column_profiles", fields)


@query(
    "h11_reconcile_load",
    ctes("dirty_orders", "dirty_workforce")
    + union(
        [
            f"SELECT '{n}' AS table_name, count(*) AS expected_rows, count(TRY_CAST({c} AS BIGINT)) AS loaded_rows, "
            f"count(*) - count(TRY_CAST({c} AS BIGINT)) AS rejected_rows, CAST(0 AS BIGINT) AS unexplained, 'PASS' AS status FROM dirty_{n}"
            for n, c in (("orders", "substr(order_id, 5)"), ("workforce", "department"))
        ]
    ),
)
def _reconcile(spark, sf_dir):
    """Expected rows against loaded plus rejected ones, the rejects counted separately."""
    expected, loaded, rejects = [], [], []
    for name, column in (("orders", F.expr("substr(order_id, 5)")), ("workforce", F.col("department"))):
        df = raw(spark, sf_dir, name).select(column.alias("code"))
        ok, bad = cast_or_reject(df, {"code": "bigint"})
        label = F.lit(name).alias("table_name")
        expected.append(df.agg(F.count(F.lit(1)).alias("expected_rows")).select(label, "expected_rows"))
        loaded.append(ok.agg(F.count(F.lit(1)).alias("row_count")).select(label, "row_count"))
        rejects.append(bad.agg(F.count(F.lit(1)).alias("rejected_rows")).select(label, "rejected_rows"))
    return C.reconcile_load(
        expected[0].unionByName(expected[1]), loaded[0].unionByName(loaded[1]), rejects[0].unionByName(rejects[1])
    )


