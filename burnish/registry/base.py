"""Registration helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burnish.dirty import VIEWS, dirty, table
from burnish.plans.domains import DOMAINS, Domain
from burnish.session import prepare_session

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

AS_OF = "2001-01-01"
AS_OF_EVENTS = "2024-01-25"
LEGACY = "1995-02-01"
VIEW_NAMES = tuple(VIEWS)
LEDGER_ORDER = ("posting_date", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")


def query(name: str, oracle: str | None = None):
    """Register a query; the session settings its result depends on are pinned first."""

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(prepare_session(spark), sf_dir)

        run.__name__ = name
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return wrap


def ctes(*names: str) -> str:
    """``WITH`` clause defining the named dirty views and cleaned tables, parents first."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for parent in PARENTS.get(name, ()):
            need(parent)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        need(name)
    return "WITH " + ",\n".join(f"{n} AS ({TEXTS[n]})" for n in ordered) + "\n"


TEXTS: dict[str, str] = {f"dirty_{n}": q for n, q in VIEWS.items()}
PARENTS: dict[str, tuple[str, ...]] = {}


def define(name: str, text: str, *parents: str) -> None:
    TEXTS[name] = text.strip()
    PARENTS[name] = parents


def domain(name: str, **options) -> Domain:
    if name == "catalog":
        return DOMAINS[name](**options)
    if name == "orders":
        options = {"legacy_before": LEGACY, "orphan": "customer_id >= 1000000000", **options}
    if name == "ledger":
        options = {"orphan": "vendor_id >= 1000000000", "order_by": LEDGER_ORDER, **options}
    return DOMAINS[name](as_of=AS_OF_EVENTS if name == "telemetry" else AS_OF, **options)


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return dirty(spark, sf_dir, name)


def cleaned(spark: SparkSession, sf_dir: str, name: str, **options) -> DataFrame:
    return domain(name).clean(dirty(spark, sf_dir, name), **options).frame


def layers(spark: SparkSession, sf_dir: str, name: str) -> dict[str, DataFrame]:
    return {"RAW": raw(spark, sf_dir, name), "CLEANED": cleaned(spark, sf_dir, name)}


def stamp(column: str) -> Column:
    """A timestamp as text, the same in both engines."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss").alias(column)


def project(name: str, view: str, columns: Callable[[], list[Column]], select: str) -> None:
    """A row-local query: columns over a whole dirty view or table."""
    is_view = view in VIEW_NAMES

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = dirty(spark, sf_dir, view) if is_view else table(spark, sf_dir, view)
        return df.select(*columns())

    source = f"dirty_{view}" if is_view else view
    query(name, (ctes(source) if is_view else "") + f"SELECT {select} FROM {source}")(run)


# Cleaned tables in DuckDB SQL, written from the rule descriptions.
EMAIL = r"regexp_matches(email, '^[^@]+@[^@]+\.[^@]+$')"
STATUS = "CASE WHEN status IN ('active','ACTIVE','Active','actv') THEN 'ACTIVE' ELSE upper(status) END"
INDUSTRY = (
    "CASE WHEN upper(trim(industry)) IN ('SAAS','SOFTWARE AS A SERVICE','S AS A SERVICE') THEN 'SAAS' "
    "ELSE upper(trim(industry)) END"
)
FIRMWARE_BASE = "replace(replace(lower(trim(firmware_version)), 'version ', 'v'), '_', '.')"
FIRMWARE = f"CASE WHEN starts_with({FIRMWARE_BASE}, 'v') THEN {FIRMWARE_BASE} ELSE concat('v', {FIRMWARE_BASE}) END"
DEVICE = "CASE WHEN device_type IN ('PUMP','Pump','pump') THEN 'PUMP' ELSE upper(device_type) END"
DEPARTMENT = (
    "CASE WHEN department IN ('Eng','Engineering','ENGINEERING','R&D') THEN 'ENGINEERING' "
    "WHEN department = 'Customer Success' THEN 'CUSTOMER_SUCCESS' ELSE upper(department) END"
)
EMPLOYMENT = "upper(employment_status)"
APPROVAL = "CASE WHEN approval_status = 'apprvd' THEN 'APPROVED' ELSE upper(approval_status) END"
CODE_BASE = "regexp_replace(regexp_replace(upper(trim(account_code)), '^GL-', ''), '-00$', '')"
CODE_CORE = f"CASE WHEN length({CODE_BASE}) > 4 AND starts_with({CODE_BASE}, '0') THEN substr({CODE_BASE}, 2) ELSE {CODE_BASE} END"
CODE = f"CASE WHEN length({CODE_CORE}) < 4 THEN lpad({CODE_CORE}, 4, '0') ELSE substr({CODE_CORE}, 1, 4) END"
CATEGORY = (
    "CASE WHEN category_l1 IN ('Electronics','ELECTRONICS','Elec.','electronic') THEN 'ELECTRONICS' "
    "ELSE upper(category_l1) END"
)
STRIPPED = (
    "CASE WHEN contains(description_en, '<') THEN trim(regexp_replace(description_en, '<[^>]+>', '', 'g')) "
    "ELSE description_en END"
)
NOT_HINDI = r"regexp_matches(product_name_hi, '\p{L}') AND NOT regexp_matches(product_name_hi, '\p{Devanagari}')"
NOT_JAPANESE = r"regexp_matches(product_name_ja, '\p{L}') AND NOT regexp_matches(product_name_ja, '[\p{Hiragana}\p{Katakana}\p{Han}]')"
LOWERED_EMAIL = f"CASE WHEN {EMAIL} THEN lower(email) END"



def half_up(expression: str) -> str:
    """Two-place HALF_UP of the printed value (DuckDB's ROUND works on the binary one)."""
    return f"CAST(round(CAST(CAST({expression} AS VARCHAR) AS DECIMAL(30, 14)), 2) AS DOUBLE)"


define(
    "orders_first",
    "SELECT * FROM dirty_orders QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY row_seq) = 1",
    "dirty_orders",
)
define(
    "orders_live",
    "SELECT * FROM orders_first WHERE NOT coalesce(onboarding_date > go_live_date, false)",
    "orders_first",
)
define(
    "orders_stat",
    "SELECT quantile_cont(total_amount, 0.99) AS p99, median(nps_score) AS nps, avg(health_score) AS hs FROM orders_live",
    "orders_live",
)
define(
    "clean_orders",
    f"""
SELECT row_seq, order_id, customer_id, order_date, abs(order_amount) AS order_amount, total_amount,
  {STATUS} AS status, {INDUSTRY} AS industry, trim(customer_name) AS customer_name, {LOWERED_EMAIL} AS email,
  coalesce(nps_score, nps) AS nps_score, coalesce(health_score, hs) AS health_score,
  CASE WHEN seats_used < 0 THEN 0 ELSE seats_used END AS seats_used,
  CASE WHEN arr < mrr * 12 * (1 - 1e-9) THEN mrr * 12 ELSE arr END AS arr, mrr, onboarding_date, go_live_date,
  CASE WHEN order_date > TIMESTAMP '{AS_OF}' THEN 'SCHEDULED' END AS order_date_flag,
  CASE WHEN order_amount IS NULL THEN 'NULL_MONETARY' WHEN order_amount < 0 THEN 'CONVERTED_NEGATIVE' END AS order_amount_flag,
  CASE WHEN total_amount > p99 THEN 'OUTLIER_REVIEW' END AS total_amount_flag,
  CASE WHEN customer_id >= 1000000000 THEN 'ORPHANED_FK' END AS customer_id_flag
FROM orders_live CROSS JOIN orders_stat""",
    "orders_live",
    "orders_stat",
)
define(
    "telemetry_first",
    "SELECT * FROM dirty_telemetry QUALIFY row_number() OVER (PARTITION BY device_id, reading_timestamp ORDER BY row_seq) = 1",
    "dirty_telemetry",
)
define(
    "telemetry_live",
    "SELECT * FROM telemetry_first WHERE NOT coalesce(reading_timestamp > ingestion_timestamp, false)",
    "telemetry_first",
)
define(
    "telemetry_stat",
    "SELECT median(predicted_failure_days) AS pf, median(torque_nm) AS tq FROM telemetry_live",
    "telemetry_live",
)
define(
    "clean_telemetry",
    f"""
SELECT row_seq, device_id, reading_timestamp, ingestion_timestamp, temperature_c, humidity_pct,
  CASE WHEN pressure_psi < 0 THEN NULL ELSE pressure_psi END AS pressure_psi, device_status, vibration_hz, voltage_v,
  current_a, power_kw, CASE WHEN efficiency_pct > 100 THEN 100 ELSE efficiency_pct END AS efficiency_pct,
  coalesce(predicted_failure_days, pf) AS predicted_failure_days, coalesce(torque_nm, tq) AS torque_nm,
  {FIRMWARE} AS firmware_version, {DEVICE} AS device_type,
  CASE WHEN reading_timestamp > TIMESTAMP '{AS_OF_EVENTS}' THEN 'CLOCK_DRIFT' END AS reading_ts_flag,
  CASE WHEN temperature_c > 500 OR temperature_c < -50 THEN 'SENSOR_FAULT' END AS temperature_c_flag,
  CASE WHEN pressure_psi < 0 THEN 'CALIBRATION_ERROR' END AS pressure_psi_flag,
  CASE WHEN vibration_hz = 0 AND device_status = 'running' THEN 'SENSOR_FAULT_ZERO' END AS vibration_hz_flag,
  CASE WHEN power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9) THEN 'PHYSICS_VIOLATION' END AS power_kw_flag
FROM telemetry_live CROSS JOIN telemetry_stat""",
    "telemetry_live",
    "telemetry_stat",
)
define(
    "workforce_first",
    "SELECT * FROM dirty_workforce QUALIFY row_number() OVER (PARTITION BY employee_id ORDER BY row_seq) = 1",
    "dirty_workforce",
)
define(
    "workforce_live",
    "SELECT * FROM workforce_first WHERE NOT coalesce(hire_date > termination_date, false)",
    "workforce_first",
)
define(
    "workforce_stat",
    "SELECT median(perf_rating_2024) AS rating FROM workforce_live WHERE perf_rating_2024 BETWEEN 1 AND 5",
    "workforce_live",
)
define(
    "clean_workforce",
    f"""
SELECT row_seq, employee_id, manager_id, trim(full_name) AS full_name, {LOWERED_EMAIL} AS email, hire_date, termination_date,
  {DEPARTMENT} AS department, {EMPLOYMENT} AS employment_status, abs(base_salary) AS base_salary, bonus_target, equity_grant,
  CASE WHEN total_comp < abs(base_salary) THEN abs(base_salary) + coalesce(bonus_target, 0) + coalesce(equity_grant, 0) / 4
       ELSE total_comp END AS total_comp,
  salary_band_max,
  CASE WHEN perf_rating_2024 < 1 OR perf_rating_2024 > 5 THEN rating ELSE perf_rating_2024 END AS perf_rating_2024,
  CASE WHEN pto_days_used > pto_days_used + pto_days_remaining THEN (pto_days_used + pto_days_remaining) * 9e-1
       ELSE pto_days_used END AS pto_days_used, pto_days_remaining,
  CASE WHEN hire_date > TIMESTAMP '{AS_OF}' THEN 'FUTURE_DATE_ERROR' END AS hire_date_flag,
  CASE WHEN base_salary < 0 THEN 'NEGATIVE_SALARY' END AS base_salary_flag,
  CASE WHEN manager_id IS NOT NULL AND manager_id NOT IN (SELECT employee_id FROM workforce_live) THEN 'ORPHANED_FK' END AS manager_id_flag,
  CASE WHEN abs(base_salary) > salary_band_max THEN 'ABOVE_BAND_MAX' END AS salary_band_flag
FROM workforce_live CROSS JOIN workforce_stat""",
    "workforce_live",
    "workforce_stat",
)
define(
    "ledger_first",
    "SELECT * FROM dirty_ledger QUALIFY row_number() OVER (PARTITION BY transaction_id "
    "ORDER BY posting_date, l_partkey, l_suppkey, l_extendedprice, l_quantity) = 1",
    "dirty_ledger",
)
define(
    "ledger_fx",
    "SELECT currency AS cur, median(fx_rate) AS rate FROM ledger_first "
    "WHERE currency IN ('EUR','GBP','JPY','INR','CAD','AUD') GROUP BY currency",
    "ledger_first",
)
NET = (
    "CASE WHEN abs(net_amount - (abs(debit_amount) - credit_amount)) > 1e-2 "
    "THEN abs(debit_amount) - credit_amount ELSE net_amount END"
)
define(
    "ledger_money",
    f"SELECT *, {half_up('abs(debit_amount)')} AS debit2, {half_up('credit_amount')} AS credit2, "
    f"{half_up(NET)} AS net2 FROM ledger_first",
    "ledger_first",
)
define(
    "ledger_off",
    "SELECT journal_entry_id AS je, abs(sum(debit2) - sum(credit2)) > 1e-2 AS off_all, "
    "coalesce(abs(sum(CASE WHEN intercompany_flag = 1 THEN debit2 END) - sum(CASE WHEN intercompany_flag = 1 THEN credit2 END)) > 1e-2, false) AS off_ic "
    "FROM ledger_money GROUP BY journal_entry_id",
    "ledger_money",
)
define(
    "clean_ledger",
    f"""
SELECT transaction_id, journal_entry_id, l_partkey, l_suppkey, l_quantity, l_extendedprice, posting_date, effective_date,
  approval_date, debit2 AS debit_amount, credit2 AS credit_amount, net2 AS net_amount, currency,
  coalesce(fx_rate, rate) AS fx_rate, {CODE} AS account_code, {APPROVAL} AS approval_status, vendor_id, intercompany_flag,
  CASE WHEN debit_amount < 0 THEN 'NEGATIVE_DEBIT' END AS debit_amount_flag,
  CASE WHEN posting_date > TIMESTAMP '{AS_OF}' THEN 'FUTURE_DATE' END AS posting_date_flag,
  CASE WHEN date_sub('day', effective_date, posting_date) > 365 THEN 'UNUSUAL_LAG_365D' END AS effective_date_flag,
  CASE WHEN approval_date < posting_date THEN 'APPROVED_BEFORE_POSTED' END AS approval_date_flag,
  CASE WHEN vendor_id >= 1000000000 THEN 'ORPHANED_FK' END AS vendor_id_flag,
  CASE WHEN off_all THEN 'IMBALANCED_JOURNAL' END AS journal_entry_id_flag,
  CASE WHEN off_ic AND intercompany_flag = 1 THEN 'INTERCOMPANY_IMBALANCE' END AS ic_unbalanced_flag
FROM ledger_money JOIN ledger_off ON journal_entry_id = je LEFT JOIN ledger_fx ON currency = cur""",
    "ledger_money",
    "ledger_off",
    "ledger_fx",
)
define(
    "catalog_first",
    "SELECT * FROM dirty_catalog QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY row_seq) = 1",
    "dirty_catalog",
)
define(
    "catalog_live",
    "SELECT * FROM catalog_first WHERE NOT coalesce(created_at > published_at, false)",
    "catalog_first",
)
define(
    "clean_catalog",
    f"""
SELECT row_seq, product_id, abs(price_usd) AS price_usd, price_eur,
  CASE WHEN margin_pct < -50 THEN -50 WHEN margin_pct > 100 THEN 100 ELSE margin_pct END AS margin_pct,
  CASE WHEN stock_quantity < 0 THEN 0 ELSE stock_quantity END AS stock_quantity, weight_kg,
  CASE WHEN abs(weight_lbs - weight_kg * 2205e-3) > 1e-2 THEN weight_kg * 2205e-3 ELSE weight_lbs END AS weight_lbs,
  {CATEGORY} AS category_l1, {STRIPPED} AS description_en, coalesce(product_name_hi, 'UNKNOWN') AS product_name_hi,
  coalesce(product_name_ja, 'UNKNOWN') AS product_name_ja, created_at, published_at,
  CASE WHEN price_usd IS NULL THEN 'NULL_MONETARY' WHEN price_usd < 0 THEN 'CONVERTED_NEGATIVE' END AS price_usd_flag,
  CASE WHEN abs(price_eur - abs(price_usd) * 92e-2) > 1e-2 THEN 'STALE_FX' END AS price_eur_flag,
  CASE WHEN {NOT_HINDI} THEN 'WRONG_LANGUAGE' END AS product_name_hi_flag,
  CASE WHEN {NOT_JAPANESE} THEN 'WRONG_LANGUAGE' END AS product_name_ja_flag
FROM catalog_live""",
    "catalog_live",
)
