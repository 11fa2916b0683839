"""Cleaning action queries (sections E and J)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from burnish.dirty import table
from burnish.functions.numbers import days_between
from burnish.operators import actions as A
from burnish.operators import dedupe as Q
from burnish.operators import detect as D
from burnish.operators.language import wrong_language
from burnish.plans.domains import DEPARTMENT, FX_CURRENCIES
from burnish.plans.domains import EMPLOYMENT as EMPLOYMENT_MAP
from burnish.functions.text import map_values
from burnish.registry.base import (
    AS_OF,
    AS_OF_EVENTS,
    EMPLOYMENT,
    ORACLES,
    cleaned,
    ctes,
    domain,
    half_up,
    query,
    raw,
)
from burnish.registry.base import DEPARTMENT as DEPARTMENT_SQL
from burnish.registry.detection import KEYS

LEDGER_ORDER = ["posting_date", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity"]


def action(name: str, view: str, fn, show: list[str], sql: str, source: str | None = None, extra: tuple = ()) -> None:
    """A cleaning action over a whole view; ``sql`` lists its columns after the keys."""
    keys = KEYS[view]

    def run(spark, sf_dir) -> DataFrame:
        return fn(raw(spark, sf_dir, view)).select(*keys, *show)

    text = source or f"SELECT {', '.join(keys)}, {sql} FROM dirty_{view}"
    query(name, ctes(f"dirty_{view}", *extra) + text)(run)


# Deduplication and deletion.
action(
    "e1_dedupe_first", "orders", lambda df: Q.dedupe_first(df, ["order_id"], ["row_seq"]), ["order_id", "arr"], "",
    "SELECT row_seq, order_id, arr FROM orders_first", ("orders_first",),
)
action(
    "e2_dedupe_first_composite", "telemetry",
    lambda df: Q.dedupe_first(df, ["device_id", "reading_timestamp"], ["row_seq"]), ["device_id", "power_kw"], "",
    "SELECT row_seq, device_id, power_kw FROM telemetry_first", ("telemetry_first",),
)
action(
    "e3_dedupe_first_catalog", "catalog", lambda df: Q.dedupe_first(df, ["product_id"], ["row_seq"]),
    ["product_id", "price_eur"], "", "SELECT row_seq, product_id, price_eur FROM catalog_first", ("catalog_first",),
)
action(
    "e4_dedupe_latest", "workforce", lambda df: Q.dedupe_latest(df, ["employee_id"], "hire_date", ["row_seq"]),
    ["employee_id"], "",
    "SELECT row_seq, employee_id FROM dirty_workforce QUALIFY row_number() OVER "
    "(PARTITION BY employee_id ORDER BY hire_date DESC NULLS LAST, row_seq) = 1",
)
action(
    "e5_drop_null_key", "workforce", lambda df: Q.drop_null_key(df, "manager_id"), ["manager_id"], "",
    "SELECT row_seq, manager_id FROM dirty_workforce WHERE manager_id IS NOT NULL",
)
for _view, _start, _end in (
    ("orders", "onboarding_date", "go_live_date"),
    ("telemetry", "reading_timestamp", "ingestion_timestamp"),
    ("workforce", "hire_date", "termination_date"),
    ("catalog", "created_at", "published_at"),
):
    action(
        f"e6_drop_sequence_break_{_view}", _view,
        lambda df, a=_start, b=_end: A.drop_sequence_break(df, a, b), [], "",
        f"SELECT row_seq FROM dirty_{_view} WHERE NOT coalesce({_start} > {_end}, false)",
    )
action(
    "e7_flag_future", "telemetry", lambda df: A.flag_future(df, "reading_timestamp", AS_OF_EVENTS, "CLOCK_DRIFT"),
    ["reading_timestamp_flag"],
    f"CASE WHEN reading_timestamp > TIMESTAMP '{AS_OF_EVENTS}' THEN 'CLOCK_DRIFT' END AS reading_timestamp_flag",
)
action(
    "e8_drop_future", "orders", lambda df: A.drop_future(df, "go_live_date", AS_OF), [], "",
    f"SELECT row_seq FROM dirty_orders WHERE NOT coalesce(go_live_date > TIMESTAMP '{AS_OF}', false)",
)
_NULL_SHARE = "(SELECT 1 - count({c}) / count(*) FROM dirty_workforce)"
action(
    "e9_drop_null_temporal", "workforce", lambda df: A.drop_null_temporal(df, "hire_date"), ["hire_date_flag"], "",
    "SELECT row_seq, CASE WHEN hire_date IS NULL THEN 'NULL_TEMPORAL' END AS hire_date_flag FROM dirty_workforce "
    f"WHERE hire_date IS NOT NULL OR {_NULL_SHARE.format(c='hire_date')} >= 5e-2",
)
action(
    "e9_drop_null_temporal_high", "workforce", lambda df: A.drop_null_temporal(df, "termination_date"),
    ["termination_date_flag"], "",
    "SELECT row_seq, CASE WHEN termination_date IS NULL THEN 'NULL_TEMPORAL' END AS termination_date_flag FROM dirty_workforce "
    f"WHERE termination_date IS NOT NULL OR {_NULL_SHARE.format(c='termination_date')} >= 5e-2",
)

# Money.
action(
    "e10_flag_null", "orders", lambda df: A.flag_null(df, "order_amount"), ["order_amount", "order_amount_flag"],
    "order_amount, CASE WHEN order_amount IS NULL THEN 'NULL_MONETARY' END AS order_amount_flag",
)
action(
    "e11_abs_and_flag", "orders", lambda df: A.abs_and_flag(df, "order_amount", "CONVERTED_NEGATIVE"),
    ["order_amount", "order_amount_flag"],
    "abs(order_amount) AS order_amount, CASE WHEN order_amount < 0 THEN 'CONVERTED_NEGATIVE' END AS order_amount_flag",
)
action(
    "e12_flag_negative", "catalog", lambda df: A.flag_negative(df, "price_usd"), ["price_usd", "price_usd_flag"],
    "price_usd, CASE WHEN price_usd < 0 THEN 'NEGATIVE_MONETARY' END AS price_usd_flag",
)
action(
    "e13_flag_outlier", "orders", lambda df: A.flag_outlier(df, "total_amount"), ["total_amount_flag"],
    "CASE WHEN total_amount > (SELECT quantile_cont(total_amount, 0.99) FROM dirty_orders) THEN 'OUTLIER_REVIEW' END AS total_amount_flag",
)


def _fence(column: str, view: str) -> str:
    return (
        f"(SELECT quantile_cont({column}, 0.75) + 3 * (quantile_cont({column}, 0.75) - quantile_cont({column}, 0.25)) FROM dirty_{view})"
    )


def _share(column: str, view: str) -> str:
    return f"(SELECT count(*) FILTER ({column} > {_fence(column, view)}) / count({column}) FROM dirty_{view})"


action(
    "e14_flag_by_outlier_rate", "orders", lambda df: A.flag_by_outlier_rate(df, "total_amount"), ["total_amount_flag"],
    f"CASE WHEN {_share('total_amount', 'orders')} < 5e-2 THEN CASE WHEN total_amount > {_fence('total_amount', 'orders')} "
    "THEN 'POTENTIAL_ENTERPRISE_DEAL' END WHEN total_amount IS NOT NULL THEN 'DISTRIBUTION_REVIEW' END AS total_amount_flag",
)
action(
    "e15_winsorise", "orders", lambda df: A.winsorise(df, "total_amount"), ["total_amount", "total_amount_flag"],
    f"CASE WHEN {_share('total_amount', 'orders')} BETWEEN 1e-2 AND 5e-2 THEN least(total_amount, "
    "(SELECT quantile_cont(total_amount, 0.99) FROM dirty_orders)) ELSE total_amount END AS total_amount, "
    f"CASE WHEN {_share('total_amount', 'orders')} > 5e-2 THEN 'DISTRIBUTION_REVIEW' WHEN {_share('total_amount', 'orders')} >= 1e-2 "
    "AND total_amount > (SELECT quantile_cont(total_amount, 0.99) FROM dirty_orders) THEN 'CAPPED_P99' END AS total_amount_flag",
)
action(
    "e15_winsorise_kept", "orders", lambda df: A.winsorise(df, "arr"), ["arr"], "arr",
)

# Numbers.
action(
    "e19_floor_zero", "orders", lambda df: A.floor_zero(df, "seats_used"), ["seats_used"],
    "CASE WHEN seats_used < 0 THEN 0 ELSE seats_used END AS seats_used",
)
action(
    "e20_null_negative", "telemetry", lambda df: A.null_negative(df, "pressure_psi", "CALIBRATION_ERROR"),
    ["pressure_psi", "pressure_psi_flag"],
    "CASE WHEN pressure_psi >= 0 THEN pressure_psi END AS pressure_psi, "
    "CASE WHEN pressure_psi < 0 THEN 'CALIBRATION_ERROR' END AS pressure_psi_flag",
)
action(
    "e21_cap_upper", "telemetry", lambda df: A.cap_upper(df, "efficiency_pct", 100), ["efficiency_pct"],
    "least(efficiency_pct, 100) AS efficiency_pct",
)
action(
    "e22_cap_range", "catalog", lambda df: A.cap_range(df, "margin_pct", -50, 100, "CAPPED"),
    ["margin_pct", "margin_pct_flag"],
    "greatest(-50, least(100, margin_pct)) AS margin_pct, "
    "CASE WHEN margin_pct < -50 OR margin_pct > 100 THEN 'CAPPED' END AS margin_pct_flag",
)
action(
    "e23_median_if_out_of_range", "workforce", lambda df: A.median_if_out_of_range(df, ["perf_rating_2024"], 1, 5),
    ["perf_rating_2024"],
    "CASE WHEN perf_rating_2024 < 1 OR perf_rating_2024 > 5 THEN (SELECT median(perf_rating_2024) FROM dirty_workforce "
    "WHERE perf_rating_2024 BETWEEN 1 AND 5) ELSE perf_rating_2024 END AS perf_rating_2024",
)
action(
    "e24_flag_range", "telemetry", lambda df: A.flag_range(df, "temperature_c", -50, 500, "SENSOR_FAULT"),
    ["temperature_c", "temperature_c_flag"],
    "temperature_c, CASE WHEN temperature_c > 500 OR temperature_c < -50 THEN 'SENSOR_FAULT' END AS temperature_c_flag",
)


def flagged(name: str, view: str, flag: str, predicate, label: str, sql: str) -> None:
    action(
        name, view, lambda df: A.flag_when(df, flag, predicate(), label), [flag],
        f"CASE WHEN {sql} THEN '{label}' END AS {flag}",
    )


flagged(
    "e25_flag_conditional_zero", "telemetry", "vibration_hz_flag",
    lambda: D.conditional_value(F.col("vibration_hz"), 0, F.col("device_status") == "running"), "SENSOR_FAULT_ZERO",
    "vibration_hz = 0 AND device_status = 'running'",
)
flagged(
    "e26_flag_physics", "telemetry", "power_kw_flag",
    lambda: D.physics_break(F.col("power_kw"), F.col("voltage_v"), F.col("current_a")), "PHYSICS_VIOLATION",
    "power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9)",
)
flagged(
    "e27_flag_band", "workforce", "salary_band_flag",
    lambda: D.above_band(F.col("base_salary"), F.col("salary_band_max")), "ABOVE_BAND_MAX",
    "base_salary > salary_band_max",
)
flagged(
    "e28_flag_lag", "ledger", "effective_date_flag",
    lambda: days_between(F.col("effective_date"), F.col("posting_date")) > 365, "UNUSUAL_LAG_365D",
    "date_sub('day', effective_date, posting_date) > 365",
)
flagged(
    "e28_flag_approval_order", "ledger", "approval_date_flag",
    lambda: F.col("approval_date") < F.col("posting_date"), "APPROVED_BEFORE_POSTED", "approval_date < posting_date",
)


# References and groups.
def _flag_vendor(spark, sf_dir):
    df = A.flag_orphan(raw(spark, sf_dir, "ledger"), "vendor_id", table(spark, sf_dir, "supplier"), "s_suppkey")
    return df.select(*KEYS["ledger"], "vendor_id_flag")


query(
    "e29_flag_orphan",
    ctes("dirty_ledger")
    + "SELECT transaction_id, l_partkey, l_suppkey, CASE WHEN vendor_id NOT IN (SELECT s_suppkey FROM supplier) "
    "THEN 'ORPHANED_FK' END AS vendor_id_flag FROM dirty_ledger",
)(_flag_vendor)


@query(
    "e29_flag_orphan_self",
    ctes("workforce_live")
    + "SELECT row_seq, CASE WHEN manager_id IS NOT NULL AND manager_id NOT IN (SELECT employee_id FROM workforce_live) "
    "THEN 'ORPHANED_FK' END AS manager_id_flag FROM workforce_live",
)
def _flag_manager(spark, sf_dir):
    survivors = domain("workforce").clean(raw(spark, sf_dir, "workforce")).survivors
    return A.flag_orphan(survivors, "manager_id", survivors, "employee_id").select("row_seq", "manager_id_flag")


flagged(
    "e30_flag_orphan_pattern", "orders", "customer_id_flag", lambda: F.col("customer_id") >= 1_000_000_000, "ORPHANED_FK",
    "customer_id >= 1000000000",
)
_OFF = "SELECT journal_entry_id FROM dirty_ledger {w} GROUP BY 1 HAVING abs(sum(debit_amount) - sum(credit_amount)) > 1e-2"
action(
    "e31_flag_group", "ledger",
    lambda df: A.flag_group(df, "journal_entry_id", "debit_amount", "credit_amount", "IMBALANCED_JOURNAL"),
    ["journal_entry_id_flag"],
    f"CASE WHEN journal_entry_id IN ({_OFF.format(w='')}) THEN 'IMBALANCED_JOURNAL' END AS journal_entry_id_flag",
)
action(
    "e32_flag_group_intercompany", "ledger",
    lambda df: A.flag_group(
        df, "journal_entry_id", "debit_amount", "credit_amount", "INTERCOMPANY_IMBALANCE",
        where="intercompany_flag = 1", flag="ic_unbalanced_flag",
    ),
    ["ic_unbalanced_flag"],
    f"CASE WHEN intercompany_flag = 1 AND journal_entry_id IN ({_OFF.format(w='WHERE intercompany_flag = 1')}) "
    "THEN 'INTERCOMPANY_IMBALANCE' END AS ic_unbalanced_flag",
)

# Recomputation and rounding.
action(
    "e33_recompute_ratio", "orders",
    lambda df: A.recompute(df, "arr", F.col("mrr") * 12, D.shortfall(F.col("arr"), F.col("mrr") * 12)), ["arr"],
    "CASE WHEN arr < mrr * 12 * (1 - 1e-9) THEN mrr * 12 ELSE arr END AS arr",
)
action(
    "e34_recompute_sum", "workforce",
    lambda df: A.recompute(
        A.abs_and_flag(df, "base_salary", "NEGATIVE_SALARY"),
        "total_comp",
        F.col("base_salary") + F.coalesce("bonus_target", F.lit(0.0)) + F.coalesce("equity_grant", F.lit(0.0)) / 4,
        F.col("total_comp") < F.col("base_salary"),
    ),
    ["total_comp"],
    "CASE WHEN total_comp < abs(base_salary) THEN abs(base_salary) + coalesce(bonus_target, 0) + coalesce(equity_grant, 0) / 4 "
    "ELSE total_comp END AS total_comp",
)
_GAP = "abs(net_amount - (abs(debit_amount) - credit_amount)) > 1e-2"
action(
    "e35_recompute_difference", "ledger",
    lambda df: A.recompute(
        A.abs_and_flag(df, "debit_amount", "NEGATIVE_DEBIT"),
        "net_amount",
        F.col("debit_amount") - F.col("credit_amount"),
        D.identity_break(F.col("net_amount"), F.col("debit_amount") - F.col("credit_amount"), 0.01),
    ),
    ["net_amount"],
    f"CASE WHEN {_GAP} THEN abs(debit_amount) - credit_amount ELSE net_amount END AS net_amount",
)
action(
    "e36_round_money", "ledger", lambda df: A.round_money(df, ["debit_amount", "credit_amount", "net_amount"]),
    ["debit_amount", "credit_amount", "net_amount"],
    ", ".join(f"{half_up(c)} AS {c}" for c in ("debit_amount", "credit_amount", "net_amount")),
)
action(
    "e37_cap_balance", "workforce", lambda df: A.cap_balance(df, "pto_days_used", "pto_days_remaining"), ["pto_days_used"],
    "CASE WHEN pto_days_used > pto_days_used + pto_days_remaining THEN (pto_days_used + pto_days_remaining) * 9e-1 "
    "ELSE pto_days_used END AS pto_days_used",
)

# Imputation.
action(
    "e38_impute_median", "telemetry", lambda df: A.impute_median(df, ["predicted_failure_days", "torque_nm"]),
    ["predicted_failure_days", "torque_nm"],
    "coalesce(predicted_failure_days, (SELECT median(predicted_failure_days) FROM dirty_telemetry)) AS predicted_failure_days, "
    "coalesce(torque_nm, (SELECT median(torque_nm) FROM dirty_telemetry)) AS torque_nm",
)
action(
    "e39_impute_mean", "orders", lambda df: A.impute_mean(df, ["health_score"]), ["health_score"],
    "coalesce(health_score, (SELECT avg(health_score) FROM dirty_orders)) AS health_score",
)
action(
    "e40_impute_group_median", "ledger",
    lambda df: A.impute_group_median(df, "fx_rate", ["currency"], list(FX_CURRENCIES)), ["fx_rate"], "",
    "SELECT transaction_id, l_partkey, l_suppkey, coalesce(fx_rate, m) AS fx_rate FROM dirty_ledger LEFT JOIN "
    "(SELECT currency AS c, median(fx_rate) AS m FROM dirty_ledger WHERE currency IN ('EUR','GBP','JPY','INR','CAD','AUD') GROUP BY 1) "
    "ON c = currency",
)
action(
    "e40_impute_group_median_month", "ledger",
    lambda df: A.impute_group_median(
        df.withColumn("posting_month", F.date_format("posting_date", "yyyy-MM")), "fx_rate", ["currency", "posting_month"]
    ).withColumn("fx_rate", F.round("fx_rate", 9)),
    ["fx_rate"], "",
    "SELECT transaction_id, l_partkey, l_suppkey, round(coalesce(fx_rate, m), 9) AS fx_rate FROM dirty_ledger LEFT JOIN "
    "(SELECT currency AS c, strftime(posting_date, '%Y-%m') AS pm, median(fx_rate) AS m FROM dirty_ledger GROUP BY 1, 2) "
    "ON c = currency AND pm = strftime(posting_date, '%Y-%m')",
)

def _mode_names(spark, sf_dir):
    return A.impute_mode(raw(spark, sf_dir, "catalog"), ["product_name_hi"]).select("row_seq", "product_name_hi")


query(
    "e41_impute_mode",
    ctes("dirty_catalog")
    + "SELECT row_seq, coalesce(product_name_hi, (SELECT product_name_hi FROM dirty_catalog WHERE product_name_hi IS NOT NULL "
    "GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)) AS product_name_hi FROM dirty_catalog",
)(_mode_names)
action(
    "e42_impute_const", "catalog", lambda df: A.impute_const(df, ["product_name_hi", "product_name_ja"]),
    ["product_name_hi", "product_name_ja"],
    "coalesce(product_name_hi, 'UNKNOWN') AS product_name_hi, coalesce(product_name_ja, 'UNKNOWN') AS product_name_ja",
)
_LINE = (
    "(SELECT regr_slope(price_usd, price_eur) AS s, regr_intercept(price_usd, price_eur) AS i, median(price_usd) AS m FROM dirty_catalog)"
)
action(
    "e43_impute_regression", "catalog", lambda df: A.impute_regression(df, "price_usd", "price_eur").withColumn(
        "price_usd", F.round("price_usd", 6)
    ),
    ["price_usd"], "",
    f"SELECT row_seq, round(coalesce(price_usd, s * price_eur + i, m), 6) AS price_usd FROM dirty_catalog, {_LINE}",
)
_SKEW = "(SELECT avg(power({c} - a, 3)) / power(any_value(s), 3) FROM dirty_{v}, (SELECT avg({c}) AS a, stddev_pop({c}) AS s FROM dirty_{v}))"
action(
    "e44_impute_by_skew", "telemetry",
    lambda df: A.impute_by_skew(df, ["predicted_failure_days", "torque_nm"]).withColumns(
        {c: F.round(c, 6) for c in ("predicted_failure_days", "torque_nm")}
    ),
    ["predicted_failure_days", "torque_nm"],
    ", ".join(
        f"round(coalesce({c}, CASE WHEN {_SKEW.format(c=c, v='telemetry')} > 2 THEN (SELECT median({c}) FROM dirty_telemetry) "
        f"ELSE (SELECT avg({c}) FROM dirty_telemetry) END), 6) AS {c}"
        for c in ("predicted_failure_days", "torque_nm")
    ),
)


@query(
    "e45_drop_sparse",
    ctes("dirty_workforce")
    + "SELECT row_seq, bonus_target, equity_grant, full_name FROM dirty_workforce",
)
def _drop_sparse(spark, sf_dir):
    """termination_date is mostly NULL and goes; the others stay."""
    df = raw(spark, sf_dir, "workforce").select("row_seq", "bonus_target", "equity_grant", "full_name", "termination_date")
    return A.drop_sparse(df, 0.30)


action(
    "e46_standardise_department", "workforce",
    lambda df: df.withColumns(
        {
            "department": map_values(F.col("department"), DEPARTMENT),
            "employment_status": map_values(F.col("employment_status"), EMPLOYMENT_MAP),
        }
    ),
    ["department", "employment_status"],
    f"{DEPARTMENT_SQL} AS department, {EMPLOYMENT} AS employment_status",
)
action(
    "e48_standardise_learned", "orders", lambda df: A.standardise_learned(df, "industry"), ["industry"], "",
    "SELECT row_seq, trim(best) AS industry FROM dirty_orders LEFT JOIN (SELECT upper(trim(industry)) AS c, "
    "arg_max(industry, (n, industry)) AS best FROM (SELECT industry, count(*) AS n FROM dirty_orders WHERE industry IS NOT NULL GROUP BY 1) "
    "GROUP BY 1) ON c = upper(trim(industry))",
)
action(
    "e52_recompute_weight", "catalog",
    lambda df: A.recompute(
        df, "weight_lbs", F.col("weight_kg") * 2.205, D.unit_break(F.col("weight_kg"), F.col("weight_lbs"), 2.205)
    ),
    ["weight_lbs"],
    "CASE WHEN abs(weight_lbs - weight_kg * 2205e-3) > 1e-2 THEN weight_kg * 2205e-3 ELSE weight_lbs END AS weight_lbs",
)
flagged(
    "e53_flag_stale_rate", "catalog", "price_eur_flag",
    lambda: D.stale_rate(F.abs("price_usd"), F.col("price_eur"), 0.92), "STALE_FX",
    "abs(price_eur - abs(price_usd) * 92e-2) > 1e-2",
)


@query(
    "e54_flag_wrong_language",
    f"SELECT doc_id, lang, CASE WHEN wrong THEN 'WRONG_LANGUAGE' END AS text_flag FROM ({ORACLES['d28_wrong_language']})",
)
def _flag_language(spark, sf_dir):
    df = table(spark, sf_dir, "documents")
    return A.flag_when(df, "text_flag", wrong_language(F.col("text"), F.col("lang")), "WRONG_LANGUAGE").select(
        "doc_id", "lang", "text_flag"
    )


@query(
    "e55_preserve_null",
    ctes("clean_workforce")
    + "SELECT row_seq, bonus_target, bonus_target IS NULL AND NOT coalesce(department = 'ENGINEERING', false) AS counts_as_missing FROM clean_workforce",
)
def _preserve(spark, sf_dir):
    """A NULL bonus stays NULL; rows of the exempt group carry no penalty."""
    exempt = domain("workforce", contractor="department = 'ENGINEERING'")
    frame = exempt.clean(raw(spark, sf_dir, "workforce")).frame
    check = next(c for c in exempt.checks if c.name == "null_bonus")
    return frame.select("row_seq", "bonus_target", check.predicate().alias("counts_as_missing"))


@query(
    "e56_flag_only",
    ctes("dirty_orders")
    + "SELECT row_seq, order_amount, status, "
    "CASE WHEN order_amount IS NULL THEN 'NULL_MONETARY' WHEN order_amount < 0 THEN 'CONVERTED_NEGATIVE' END AS order_amount_flag, "
    "CASE WHEN total_amount > (SELECT quantile_cont(total_amount, 0.99) FROM dirty_orders) THEN 'OUTLIER_REVIEW' END AS total_amount_flag "
    "FROM dirty_orders",
)
def _flag_only(spark, sf_dir):
    return cleaned(spark, sf_dir, "orders", mode="flag_only").select(
        "row_seq", "order_amount", "status", "order_amount_flag", "total_amount_flag"
    )


# Window-shaped forms.
@query(
    "j1_first_per_key",
    "SELECT o_custkey, min(o_orderkey) AS o_orderkey FROM "
    "(SELECT o_custkey, o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS r FROM orders) WHERE r = 1 GROUP BY 1",
)
def _first_per_key(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    return Q.dedupe_first(orders, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey")


@query(
    "j2_rows_beside_total",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, "
    "sum(l_quantity) OVER (PARTITION BY l_orderkey) AS order_quantity FROM lineitem",
)
def _beside_total(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return Q.rows_beside_total(li, "l_orderkey", F.col("l_quantity"), "order_quantity").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "order_quantity"
    )


@query(
    "j3_rank",
    "SELECT o_orderpriority, revenue, CAST(dense_rank() OVER (ORDER BY revenue DESC) AS INTEGER) AS revenue_rank FROM "
    "(SELECT o_orderpriority, round(sum(o_totalprice), 2) AS revenue FROM orders GROUP BY 1)",
)
def _rank(spark, sf_dir):
    """Rank of a handful of aggregated rows (one per priority)."""
    revenue = table(spark, sf_dir, "orders").groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("revenue"))
    return revenue.withColumn("revenue_rank", F.dense_rank().over(Window.orderBy(F.desc("revenue"))))
