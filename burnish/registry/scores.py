"""Quality score queries (section G)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnish.plans import score as S
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
    LEGACY,
    NOT_HINDI,
    NOT_JAPANESE,
    STATUS,
    VIEW_NAMES,
    ctes,
    define,
    domain,
    layers,
    query,
    raw,
)
from burnish.registry.profiles import COLUMNS, union
from burnish.session import materialise

# Conditions that fail a row, per dimension, in DuckDB SQL.  {t} is the layer's table.
FAILS = {
    "orders": {
        "completeness": "customer_name IS NULL OR nps_score IS NULL OR health_score IS NULL OR order_amount IS NULL",
        "validity": f"NOT {EMAIL} OR seats_used < 0 OR order_amount < 0",
        "consistency": f"arr < mrr * 12 * (1 - 1e-9) OR status <> {STATUS} OR industry <> {INDUSTRY} OR customer_id >= 1000000000",
        "accuracy": f"onboarding_date > go_live_date OR order_date > TIMESTAMP '{AS_OF}' OR order_date < TIMESTAMP '{LEGACY}'",
    },
    "telemetry": {
        "completeness": "torque_nm IS NULL OR predicted_failure_days IS NULL",
        "validity": "temperature_c > 500 OR temperature_c < -50 OR pressure_psi < 0 OR efficiency_pct > 100 "
        "OR power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9)",
        "consistency": f"firmware_version <> {FIRMWARE} OR device_type <> {DEVICE} OR (vibration_hz = 0 AND device_status = 'running')",
        "accuracy": f"ingestion_timestamp < reading_timestamp OR reading_timestamp > TIMESTAMP '{AS_OF_EVENTS}'",
    },
    "workforce": {
        "completeness": "bonus_target IS NULL OR equity_grant IS NULL OR full_name IS NULL",
        "validity": f"base_salary < 0 OR NOT {EMAIL} OR perf_rating_2024 < 1 OR perf_rating_2024 > 5",
        "consistency": f"department <> {DEPARTMENT} OR employment_status <> {EMPLOYMENT} OR "
        "(manager_id IS NOT NULL AND manager_id NOT IN (SELECT employee_id FROM {t}))",
        "accuracy": f"hire_date > termination_date OR hire_date > TIMESTAMP '{AS_OF}' OR total_comp < base_salary OR base_salary > salary_band_max",
    },
    "ledger": {
        "completeness": "fx_rate IS NULL AND currency <> 'USD'",
        "validity": "abs(debit_amount - round(debit_amount, 2)) > 1e-9 OR debit_amount < 0",
        "consistency": f"account_code <> {CODE} OR approval_status <> {APPROVAL} OR vendor_id >= 1000000000",
        "accuracy": "journal_entry_id IN (SELECT journal_entry_id FROM {t} GROUP BY 1 HAVING abs(sum(debit_amount) - sum(credit_amount)) > 1e-2) "
        "OR abs(net_amount - (debit_amount - credit_amount)) > 1e-2 OR approval_date < posting_date",
    },
    "catalog": {
        "completeness": "price_usd IS NULL OR product_name_hi IS NULL OR product_name_ja IS NULL",
        "validity": "price_usd < 0 OR margin_pct < -50 OR margin_pct > 100 OR regexp_matches(description_en, '<[^>]+>') OR stock_quantity < 0",
        "consistency": f"category_l1 <> {CATEGORY} OR ({NOT_HINDI}) OR ({NOT_JAPANESE})",
        "accuracy": "abs(weight_lbs - weight_kg * 2205e-3) > 1e-2 OR abs(price_eur - abs(price_usd) * 92e-2) > 1e-2 OR published_at < created_at",
    },
}
KEY_COLUMNS = {
    "orders": "order_id",
    "telemetry": "device_id, reading_timestamp",
    "workforce": "employee_id",
    "ledger": "transaction_id",
    "catalog": "product_id",
}
GRADE = "CASE WHEN {x} >= 95 THEN 'A' WHEN {x} >= 85 THEN 'B' WHEN {x} >= 70 THEN 'C' WHEN {x} >= 55 THEN 'D' ELSE 'F' END"
DIMS = ("completeness", "validity", "uniqueness", "consistency", "accuracy")
OVERALL = "round(completeness * 25e-2 + validity * 25e-2 + uniqueness * 2e-1 + consistency * 2e-1 + accuracy * 1e-1, 4)"


def dims_sql(name: str, source: str) -> str:
    cols = [
        f"count(*) FILTER (NOT coalesce({w.replace('{t}', source)}, false)) * 100 / count(*) AS {d}"
        for d, w in FAILS[name].items()
    ]
    shared = f"(SELECT coalesce(sum(n), 0) FROM (SELECT count(*) AS n FROM {source} GROUP BY {KEY_COLUMNS[name]} HAVING count(*) > 1))"
    cols.append(f"CAST(count(*) - {shared} AS BIGINT) * 100 / count(*) AS uniqueness")
    return f"SELECT count(*) AS total_rows, {', '.join(cols)} FROM {source}"


def score_sql(name: str, source: str, layer: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, '{layer}' AS layer, total_rows, {', '.join(DIMS)}, {OVERALL} AS overall, "
        f"{GRADE.format(x=OVERALL)} AS grade FROM ({dims_sql(name, source)})"
    )


for _n in VIEW_NAMES:
    define(
        f"scores_{_n}",
        union([score_sql(_n, f"dirty_{_n}", "raw"), score_sql(_n, f"clean_{_n}", "cleaned")]),
        f"dirty_{_n}",
        f"clean_{_n}",
    )
define("scores_all", union([f"SELECT * FROM scores_{n}" for n in VIEW_NAMES]), *[f"scores_{n}" for n in VIEW_NAMES])
_LONG = union([f"SELECT table_name, layer, '{d}' AS dimension, {d} AS score FROM scores_all" for d in (*DIMS, "overall")])
define(
    "compared",
    f"SELECT table_name, dimension, round(b, 4) AS before_score, round(a, 4) AS after_score, round(a - b, 4) AS gain, "
    f"concat({GRADE.format(x='b')}, ' -> ', {GRADE.format(x='a')}) AS grade_change FROM (SELECT table_name, dimension, "
    f"max(score) FILTER (layer = 'raw') AS b, max(score) FILTER (layer = 'cleaned') AS a FROM ({_LONG}) GROUP BY 1, 2)",
    "scores_all",
)


def table_scores(spark, sf_dir, name: str) -> DataFrame:
    """Raw and cleaned score rows; the cleaned table is written once and scored from there."""
    d = domain(name)
    df = raw(spark, sf_dir, name)
    result = d.clean(df)
    done = materialise(result.frame, f"clean-{name}")
    before = S.measure_layer(df, d, repeated=result.repeated(d.key))
    return S.score_layers({"raw": before.scores, "cleaned": S.measure_layer(done, d).scores}, name)


def all_scores(spark, sf_dir) -> DataFrame:
    return reduce(DataFrame.unionByName, [table_scores(spark, sf_dir, n) for n in VIEW_NAMES])


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumns({d: F.round(d, 6) for d in DIMS})


_ROUNDED = ", ".join(f"round({d}, 6) AS {d}" for d in DIMS)
for _n in VIEW_NAMES:

    @query(
        f"g1_score_dimensions_{_n}",
        ctes(f"dirty_{_n}") + f"SELECT total_rows, {_ROUNDED} FROM ({dims_sql(_n, f'dirty_{_n}')})",
    )
    def _dimensions(spark, sf_dir, name=_n):
        d = domain(name)
        df = raw(spark, sf_dir, name)
        return _rounded(S.score_dimensions(S.with_marks(df, d), d.checks, list(d.key), bare=df))

    @query(
        f"g2_overall_score_{_n}",
        ctes(f"scores_{_n}") + f"SELECT * REPLACE ({_ROUNDED}) FROM scores_{_n}",
    )
    def _overall(spark, sf_dir, name=_n):
        return _rounded(table_scores(spark, sf_dir, name))


@query(
    "g3_grade",
    ctes("dirty_orders")
    + f"SELECT 'framework' AS scale, {GRADE.format(x=OVERALL)} AS grade FROM ({dims_sql('orders', 'dirty_orders')}) UNION ALL "
    f"SELECT 'lenient', CASE WHEN {OVERALL} >= 90 THEN 'A' WHEN {OVERALL} >= 75 THEN 'B' WHEN {OVERALL} >= 60 THEN 'C' "
    f"WHEN {OVERALL} >= 45 THEN 'D' ELSE 'F' END FROM ({dims_sql('orders', 'dirty_orders')}) UNION ALL "
    f"SELECT 'null_cell', CASE WHEN {OVERALL} >= 90 THEN 'A' WHEN {OVERALL} >= 80 THEN 'B' WHEN {OVERALL} >= 70 THEN 'C' "
    f"WHEN {OVERALL} >= 60 THEN 'D' ELSE 'F' END FROM ({dims_sql('orders', 'dirty_orders')})",
)
def _grades(spark, sf_dir):
    scored = S.score_table(raw(spark, sf_dir, "orders"), domain("orders"))
    items = [
        F.struct(F.lit(s).alias("scale"), S.grade(F.col("overall"), s).alias("grade"))
        for s in ("framework", "lenient", "null_cell")
    ]
    return scored.select(F.inline(F.array(*items)))


def _unique_sql(name: str, extra: bool) -> str:
    failing = "n - 1" if extra else "CASE WHEN n > 1 THEN n ELSE 0 END"
    return (
        f"SELECT '{name}' AS table_name, CAST(sum(n) AS BIGINT) AS total_rows, CAST(sum({failing}) AS BIGINT) AS failing_rows, "
        f"round(CAST(sum(n) - sum({failing}) AS BIGINT) * 100 / CAST(sum(n) AS BIGINT), 6) AS uniqueness FROM "
        f"(SELECT count(*) AS n FROM dirty_{name} GROUP BY {KEY_COLUMNS[name]})"
    )


for _extra, _id in ((False, "g4_uniqueness"), (True, "g4_uniqueness_extra_only")):

    @query(_id, ctes(*[f"dirty_{n}" for n in VIEW_NAMES]) + union([_unique_sql(n, _extra) for n in VIEW_NAMES]))
    def _unique(spark, sf_dir, extra=_extra):
        pieces = [
            S.uniqueness(raw(spark, sf_dir, n), list(domain(n).key), extra).select(
                F.lit(n).alias("table_name"), "total_rows", "failing_rows", F.round("uniqueness", 6).alias("uniqueness")
            )
            for n in VIEW_NAMES
        ]
        return reduce(DataFrame.unionByName, pieces)


def _cells_sql(name: str) -> str:
    cols = COLUMNS[name]
    nulls = " + ".join(f"(count(*) - count({c}))" for c in cols)
    score = f"round(greatest(0, 100 - ({nulls}) * 100 / (count(*) * {len(cols)}) - {S.NULL_CELL_PENALTY[name]}), 1)"
    return (
        f"SELECT '{name}' AS table_name, {score} AS score, CASE WHEN {score} >= 90 THEN 'A' WHEN {score} >= 80 THEN 'B' "
        f"WHEN {score} >= 70 THEN 'C' WHEN {score} >= 60 THEN 'D' ELSE 'F' END AS grade FROM dirty_{name}"
    )


@query("g5_null_cell_score", ctes(*[f"dirty_{n}" for n in VIEW_NAMES]) + union([_cells_sql(n) for n in VIEW_NAMES]))
def _cell_scores(spark, sf_dir):
    pieces = [
        S.null_cell_score(raw(spark, sf_dir, n), S.NULL_CELL_PENALTY[n]).select(
            F.lit(n).alias("table_name"), "score", "grade"
        )
        for n in VIEW_NAMES
    ]
    return reduce(DataFrame.unionByName, pieces)


def layered_sql(name: str, check: str, predicate: str, digits: int = 1) -> str:
    return ctes(f"dirty_{name}", f"clean_{name}") + union(
        [
            f"SELECT '{layer}' AS layer, '{check}' AS check_name, count(*) AS total_rows, count(*) FILTER ({predicate}) AS passing_rows, "
            f"round(count(*) FILTER ({predicate}) * 100 / count(*), {digits}) AS score FROM {t}"
            for layer, t in (("RAW", f"dirty_{name}"), ("CLEANED", f"clean_{name}"))
        ]
    )


_FULL = "customer_name IS NOT NULL AND email IS NOT NULL AND order_amount IS NOT NULL AND nps_score IS NOT NULL"


@query("g6_completeness_check_orders", layered_sql("orders", "Completeness", _FULL))
def _complete_orders(spark, sf_dir):
    return S.completeness_check(layers(spark, sf_dir, "orders"), ["customer_name", "email", "order_amount", "nps_score"])


_HR = ["employee_id", "full_name", "department", "hire_date", "base_salary"]


@query("g6_completeness_check_workforce", layered_sql("workforce", "Completeness", " AND ".join(f"{c} IS NOT NULL" for c in _HR)))
def _complete_workforce(spark, sf_dir):
    return S.completeness_check(layers(spark, sf_dir, "workforce"), _HR)


_VALID_ORDER = "(email IS NULL OR email LIKE '%@%.%') AND (order_amount IS NULL OR order_amount >= 0) AND (seats_used IS NULL OR seats_used >= 0)"


@query("g7_validity_check_orders", layered_sql("orders", "Validity", _VALID_ORDER))
def _valid_orders(spark, sf_dir):
    return S.validity_check(layers(spark, sf_dir, "orders"), _VALID_ORDER)


_SENSOR = "temperature_c BETWEEN -50 AND 150 AND humidity_pct BETWEEN 0 AND 100"


@query("g7_validity_check_telemetry", layered_sql("telemetry", "Validity", _SENSOR))
def _valid_telemetry(spark, sf_dir):
    return S.validity_check(layers(spark, sf_dir, "telemetry"), _SENSOR)


@query("g7_validity_check_catalog", layered_sql("catalog", "Validity", "price_usd > 0", 2))
def _valid_catalog(spark, sf_dir):
    return S.validity_check(layers(spark, sf_dir, "catalog"), "price_usd > 0", 2)


@query("g8_consistency_check", layered_sql("ledger", "Consistency", "regexp_matches(account_code, '^[0-9]{4}$')"))
def _consistent(spark, sf_dir):
    return S.consistency_check(layers(spark, sf_dir, "ledger"), "account_code", "^[0-9]{4}$")


def _counted(name: str, column: str, predicate: str) -> str:
    return ctes(f"dirty_{name}", f"clean_{name}") + union(
        [
            f"SELECT '{layer}' AS layer, count(*) FILTER ({predicate}) AS {column} FROM {t}"
            for layer, t in (("RAW", f"dirty_{name}"), ("CLEANED", f"clean_{name}"))
        ]
    )


@query("g9_accuracy_check", _counted("workforce", "impossible_sequences", "termination_date < hire_date"))
def _accurate(spark, sf_dir):
    return S.accuracy_check(layers(spark, sf_dir, "workforce"), "hire_date", "termination_date")


@query("g10_count_where", _counted("ledger", "invalid_debits", "currency = 'USD' AND debit_amount < 0"))
def _negative_debits(spark, sf_dir):
    return S.count_where(layers(spark, sf_dir, "ledger"), "currency = 'USD' AND debit_amount < 0", "invalid_debits")


@query("g11_compare_scores", ctes("compared") + "SELECT * FROM compared")
def _compare(spark, sf_dir):
    return S.compare_scores(all_scores(spark, sf_dir))


@query(
    "g12_top_gain",
    ctes("compared")
    + "SELECT dimension, table_name, gain FROM compared WHERE dimension <> 'overall' "
    "QUALIFY dense_rank() OVER (PARTITION BY dimension ORDER BY gain DESC) = 1",
)
def _top(spark, sf_dir):
    return S.top_gain(S.compare_scores(all_scores(spark, sf_dir)))


@query(
    "g13_average_scores",
    ctes("compared")
    + "SELECT dimension, round(avg(before_score), 4) AS avg_before, round(avg(after_score), 4) AS avg_after, "
    "round(avg(gain), 4) AS avg_gain FROM compared GROUP BY dimension",
)
def _average(spark, sf_dir):
    return S.average_scores(S.compare_scores(all_scores(spark, sf_dir)))
