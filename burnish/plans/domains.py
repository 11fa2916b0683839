"""Ready-made rule sets for five kinds of table."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from burnish.plans.engine import Cleaned, clean
from burnish.plans.rules import Balance, Check, Reference, Rule, Stat

# Vocabularies, bounds and labels the results are defined by.
STATUS = {"active": "ACTIVE", "ACTIVE": "ACTIVE", "Active": "ACTIVE", "actv": "ACTIVE"}
INDUSTRY = {"SAAS": ["SAAS", "SOFTWARE AS A SERVICE", "S AS A SERVICE"]}
DEVICE_TYPE = {"PUMP": "PUMP", "Pump": "PUMP", "pump": "PUMP", "PUMP_V2": "PUMP_V2"}
DEPARTMENT = {
    "Eng": "ENGINEERING",
    "Engineering": "ENGINEERING",
    "ENGINEERING": "ENGINEERING",
    "R&D": "ENGINEERING",
    "Product": "PRODUCT",
    "Sales": "SALES",
    "Marketing": "MARKETING",
    "HR": "HR",
    "Finance": "FINANCE",
    "Legal": "LEGAL",
    "Operations": "OPERATIONS",
    "Customer Success": "CUSTOMER_SUCCESS",
}
EMPLOYMENT = {
    "active": "ACTIVE",
    "ACTIVE": "ACTIVE",
    "Active": "ACTIVE",
    "terminated": "TERMINATED",
    "Terminated": "TERMINATED",
}
APPROVAL = {
    "approved": "APPROVED",
    "APPROVED": "APPROVED",
    "Approved": "APPROVED",
    "apprvd": "APPROVED",
    "pending": "PENDING",
    "PENDING": "PENDING",
    "rejected": "REJECTED",
}
CATEGORY = {
    "Electronics": "ELECTRONICS",
    "ELECTRONICS": "ELECTRONICS",
    "Elec.": "ELECTRONICS",
    "electronic": "ELECTRONICS",
    "Clothing": "CLOTHING",
    "Food": "FOOD",
    "Sports": "SPORTS",
    "Home": "HOME",
    "Beauty": "BEAUTY",
    "Books": "BOOKS",
}
FX_CURRENCIES = ("EUR", "GBP", "JPY", "INR", "CAD", "AUD")
SENSORS = (
    "torque_nm",
    "load_pct",
    "speed_rpm",
    "displacement_mm",
    "acceleration_g",
    "jerk_ms3",
    "bearing_temp_c",
    "motor_temp_c",
    "coolant_temp_c",
    "oil_temp_c",
    "inlet_pressure",
    "outlet_pressure",
    "differential_pressure",
    "flow_velocity",
    "mass_flow_kg_s",
)
EMAIL_SQL = "email RLIKE '^[^@]+@[^@]+\\\\.[^@]+$'"
LBS_PER_KG = 2.205
LANGUAGES = {"product_name_hi": "hi", "product_name_ja": "ja"}


@dataclass(frozen=True)
class Domain:
    name: str
    key: tuple[str, ...]
    order_by: tuple[str, ...]
    rules: list[Rule]
    checks: list[Check]
    references: list[Reference] = field(default_factory=list)
    balances: list[Balance] = field(default_factory=list)

    def clean(self, df: DataFrame, masters: dict[str, DataFrame] | None = None, **options) -> Cleaned:
        present = set(df.columns)
        rules = [r for r in self.rules if r.column in present or r.stage in ("key", "impossible")]
        return clean(
            df, rules, list(self.order_by), self.references, masters, self.balances, **options
        )


def _moment(as_of: str | None) -> str:
    return "localtimestamp()" if as_of is None else f"CAST('{as_of}' AS TIMESTAMP_NTZ)"


def _dedupe(*keys: str) -> Rule:
    return Rule("PK_VIOLATION", "key", "DELETE_DUPLICATES", ",".join(keys), keys=keys)


def _sequence(start: str, end: str) -> Rule:
    return Rule("IMPOSSIBLE_SEQUENCE", "impossible", "DELETE_ROWS", f"{start}/{end}", when=f"{start} > {end}")


def _future(column: str, as_of: str | None, label: str, flag: str | None = None) -> Rule:
    return Rule(
        f"{label}_{column}", "flag", "FLAG_FUTURE", column, when=f"{column} > {_moment(as_of)}",
        flag=flag or f"{column}_flag", label=label,
    )


def _flag(name: str, stage: str, column: str, when: str, label: str, flag: str | None = None, stats=()) -> Rule:
    return Rule(name, stage, "FLAG", column, when=when, flag=flag or f"{column}_flag", label=label, stats=stats)


def _null_money(column: str) -> Rule:
    return Rule(
        "MONETARY_NULL", "money", "FLAG_NULL", column, when=f"{column} IS NULL",
        flag=f"{column}_flag", label="NULL_MONETARY",
    )


def _positive(column: str, label: str) -> Rule:
    return Rule(
        "MONETARY_NEGATIVE", "money", "CONVERT_TO_POSITIVE", column, when=f"{column} < 0", fn="abs",
        flag=f"{column}_flag", label=label,
    )


def _trim(column: str) -> Rule:
    return Rule("PII_CLEANUP", "text", "TRIM_WHITESPACE", column, fn="trim")


def _email(column: str = "email") -> Rule:
    return Rule("PII_EMAIL", "text", "NULLIFY_MALFORMED", column, fn="email")


def _map(column: str, mapping: dict[str, str]) -> Rule:
    return Rule("CATEGORY_CONSISTENCY", "text", "STANDARDIZE", column, fn="map", args={"mapping": mapping})


def _impute(column: str, kind: str, action: str) -> Rule:
    name = f"{column}_{kind}"
    return Rule(
        f"NULL_{column}", "impute", action, column, when=f"{column} IS NULL", value="{" + name + "}",
        stats=(Stat(name, kind, column),),
    )


def _floor_zero(column: str) -> Rule:
    return Rule("NUMERIC_NEGATIVE", "bounds", "SET_ZERO", column, when=f"{column} < 0", value="0")


SUFFIX_ORPHAN = "try_cast(regexp_extract(CAST({c} AS STRING), '([0-9]+)$', 1) AS BIGINT) > {limit}"


def orders(
    as_of: str | None = None,
    legacy_before: str = "2020-01-01",
    orphan: str = SUFFIX_ORPHAN.format(c="customer_id", limit=9500),
    customers: str | None = None,
    order_by: tuple[str, ...] = ("row_seq",),
) -> Domain:
    """``orphan`` is the condition of an unknown customer; ``customers`` names the key column
    of a master called "customers", which then decides instead."""
    orphan = "_orphan_customer" if customers else orphan
    p99 = Stat("total_amount_p99", "quantile", "total_amount", 0.99)
    return Domain(
        "orders",
        ("order_id",),
        tuple(order_by),
        [
            _dedupe("order_id"),
            _sequence("onboarding_date", "go_live_date"),
            _future("order_date", as_of, "SCHEDULED"),
            _null_money("order_amount"),
            _positive("order_amount", "CONVERTED_NEGATIVE"),
            _flag("MONETARY_OUTLIER", "money", "total_amount", "total_amount > {total_amount_p99}",
                  "OUTLIER_REVIEW", stats=(p99,)),
            _trim("customer_name"),
            _email(),
            _floor_zero("seats_used"),
            _map("status", STATUS),
            Rule("CATEGORY_SYNONYMS", "text", "STANDARDIZE", "industry", fn="synonyms",
                 args={"synonyms": INDUSTRY}),
            _impute("nps_score", "quantile", "IMPUTE_MEDIAN"),
            _impute("health_score", "mean", "IMPUTE_MEAN"),
            Rule("LOGIC_VIOLATION", "logic", "RECOMPUTE", "arr", when="arr < mrr * 12 * (1 - 1e-9)",
                 value="mrr * 12"),
            _flag("FK_VIOLATION", "reference", "customer_id", orphan, "ORPHANED_FK"),
        ],
        [
            Check("null_customer_name", "completeness", "WARNING", "customer_name", "customer_name IS NULL"),
            Check("null_nps_score", "completeness", "INFO", "nps_score", "nps_score IS NULL"),
            Check("null_health_score", "completeness", "INFO", "health_score", "health_score IS NULL"),
            Check("null_order_amount", "completeness", "CRITICAL", "order_amount", "order_amount IS NULL"),
            Check("malformed_email", "validity", "WARNING", "email", f"NOT {EMAIL_SQL}"),
            Check("negative_seats_used", "validity", "WARNING", "seats_used", "seats_used < 0"),
            Check("negative_order_amount", "validity", "CRITICAL", "order_amount", "order_amount < 0"),
            Check("arr_below_mrr", "consistency", "CRITICAL", "arr", "arr < mrr * 12 * (1 - 1e-9)"),
            Check("mixed_status", "consistency", "WARNING", "status", fn="map", args={"mapping": STATUS}),
            Check("mixed_industry", "consistency", "WARNING", "industry", fn="synonyms",
                  args={"synonyms": INDUSTRY}),
            Check("orphan_customer", "consistency", "CRITICAL", "customer_id", orphan),
            Check("onboarding_after_go_live", "accuracy", "CRITICAL", "onboarding_date",
                  "onboarding_date > go_live_date"),
            Check("future_order_date", "accuracy", "WARNING", "order_date", f"order_date > {_moment(as_of)}"),
            Check("legacy_order_date", "accuracy", "INFO", "order_date",
                  f"order_date < CAST('{legacy_before}' AS TIMESTAMP_NTZ)"),
        ],
        [Reference("customer_id", "customers", customers, "_orphan_customer")] if customers else [],
    )


def telemetry(as_of: str | None = None, power_factor: float = 0.001) -> Domain:
    physics = f"power_kw > voltage_v * current_a * {power_factor} * (1 + 1e-9)"
    return Domain(
        "telemetry",
        ("device_id", "reading_timestamp"),
        ("row_seq",),
        [
            _dedupe("device_id", "reading_timestamp"),
            _sequence("reading_timestamp", "ingestion_timestamp"),
            _future("reading_timestamp", as_of, "CLOCK_DRIFT", "reading_ts_flag"),
            _flag("SENSOR_RANGE", "bounds", "temperature_c", "temperature_c > 500 OR temperature_c < -50",
                  "SENSOR_FAULT"),
            Rule("IMPOSSIBLE_VALUE", "bounds", "NULLIFY_NEGATIVE", "pressure_psi", when="pressure_psi < 0",
                 value="CAST(NULL AS DOUBLE)", flag="pressure_psi_flag", label="CALIBRATION_ERROR"),
            Rule("PHYSICAL_LIMIT", "bounds", "CAP", "efficiency_pct", when="efficiency_pct > 100", value="100"),
            _flag("ZERO_WHILE_RUNNING", "logic", "vibration_hz",
                  "vibration_hz = 0 AND device_status = 'running'", "SENSOR_FAULT_ZERO"),
            _flag("PHYSICS", "logic", "power_kw", physics, "PHYSICS_VIOLATION"),
            _impute("predicted_failure_days", "quantile", "IMPUTE_MEDIAN"),
            *[_impute(c, "quantile", "IMPUTE_MEDIAN") for c in SENSORS],
            Rule("FORMAT_CONSISTENCY", "text", "STANDARDIZE", "firmware_version", fn="version"),
            _map("device_type", DEVICE_TYPE),
        ],
        [
            *[Check(f"null_{c}", "completeness", "CRITICAL", c, f"{c} IS NULL") for c in SENSORS],
            Check("null_failure_days", "completeness", "INFO", "predicted_failure_days",
                  "predicted_failure_days IS NULL"),
            Check("temperature_range", "validity", "CRITICAL", "temperature_c",
                  "temperature_c > 500 OR temperature_c < -50"),
            Check("negative_pressure", "validity", "CRITICAL", "pressure_psi", "pressure_psi < 0"),
            Check("efficiency_range", "validity", "WARNING", "efficiency_pct", "efficiency_pct > 100"),
            Check("power_physics", "validity", "CRITICAL", "power_kw", physics),
            Check("mixed_firmware", "consistency", "WARNING", "firmware_version", fn="version"),
            Check("mixed_device_type", "consistency", "WARNING", "device_type", fn="map",
                  args={"mapping": DEVICE_TYPE}),
            Check("zero_vibration", "consistency", "WARNING", "vibration_hz",
                  "vibration_hz = 0 AND device_status = 'running'"),
            Check("ingested_before_read", "accuracy", "CRITICAL", "ingestion_timestamp",
                  "ingestion_timestamp < reading_timestamp"),
            Check("future_reading", "accuracy", "WARNING", "reading_timestamp",
                  f"reading_timestamp > {_moment(as_of)}"),
        ],
    )


def workforce(as_of: str | None = None, impute_equity: bool = False, contractor: str | None = None) -> Domain:
    """``contractor`` is a predicate whose rows may lack a bonus without penalty."""
    ratings = [f"perf_rating_{year}" for year in range(2019, 2025)]
    exempt = "" if contractor is None else f" AND NOT coalesce({contractor}, false)"
    rating_rules = [
        Rule("RATING_RANGE", "bounds", "MEDIAN_IF_OUT_OF_RANGE", c, when=f"{c} < 1 OR {c} > 5",
             value="{" + f"{c}_mid" + "}", stats=(Stat(f"{c}_mid", "quantile", c, 0.5, f"{c} BETWEEN 1 AND 5"),))
        for c in ratings
    ]
    return Domain(
        "workforce",
        ("employee_id",),
        ("row_seq",),
        [
            _dedupe("employee_id"),
            _sequence("hire_date", "termination_date"),
            _future("hire_date", as_of, "FUTURE_DATE_ERROR"),
            _positive("base_salary", "NEGATIVE_SALARY"),
            Rule("TOTAL_COMP", "derive", "RECOMPUTE", "total_comp", when="total_comp < base_salary",
                 value="base_salary + coalesce(bonus_target, 0) + coalesce(equity_grant, 0) / 4"),
            Rule("PRESERVE_NULL", "derive", "PRESERVE", "bonus_target", when="bonus_target IS NULL"),
            *([_impute("equity_grant", "quantile", "IMPUTE_MEDIAN")] if impute_equity else []),
            _trim("full_name"),
            _email(),
            _map("department", DEPARTMENT),
            _map("employment_status", EMPLOYMENT),
            *rating_rules,
            Rule("LEAVE_BALANCE", "bounds", "CAP_BALANCE", "pto_days_used",
                 when="pto_days_used > pto_days_used + pto_days_remaining",
                 value="(pto_days_used + pto_days_remaining) * 0.9D"),
            _flag("FK_VIOLATION", "reference", "manager_id", "_orphan_manager", "ORPHANED_FK"),
            _flag("SALARY_BAND", "logic", "salary_band_max", "base_salary > salary_band_max", "ABOVE_BAND_MAX",
                  flag="salary_band_flag"),
        ],
        [
            Check("null_bonus", "completeness", "INFO", "bonus_target", f"bonus_target IS NULL{exempt}"),
            Check("null_equity", "completeness", "INFO", "equity_grant", "equity_grant IS NULL"),
            Check("null_name", "completeness", "WARNING", "full_name", "full_name IS NULL"),
            Check("negative_salary", "validity", "CRITICAL", "base_salary", "base_salary < 0"),
            Check("malformed_email", "validity", "WARNING", "email", f"NOT {EMAIL_SQL}"),
            *[Check(f"range_{c}", "validity", "WARNING", c, f"{c} < 1 OR {c} > 5") for c in ratings],
            Check("mixed_department", "consistency", "WARNING", "department", fn="map",
                  args={"mapping": DEPARTMENT}),
            Check("mixed_employment", "consistency", "WARNING", "employment_status", fn="map",
                  args={"mapping": EMPLOYMENT}),
            Check("orphan_manager", "consistency", "CRITICAL", "manager_id", "_orphan_manager"),
            Check("hired_after_termination", "accuracy", "CRITICAL", "hire_date", "hire_date > termination_date"),
            Check("future_hire", "accuracy", "WARNING", "hire_date", f"hire_date > {_moment(as_of)}"),
            Check("comp_below_salary", "accuracy", "CRITICAL", "total_comp", "total_comp < base_salary"),
            Check("above_band", "accuracy", "WARNING", "base_salary", "base_salary > salary_band_max"),
        ],
        [Reference("manager_id", "self", "employee_id", "_orphan_manager")],
    )


def ledger(
    as_of: str | None = None,
    orphan: str = "contains(CAST(vendor_id AS STRING), 'GHOST')",
    vendors: str | None = None,
    order_by: tuple[str, ...] = ("posting_date",),
) -> Domain:
    """``orphan`` and ``vendors`` as in ``orders``; ties in ``order_by`` are settled by the other columns."""
    orphan = "_orphan_vendor" if vendors else orphan
    fx = [
        Rule("GROUPED_IMPUTATION", "impute", "IMPUTE_MEDIAN_BY_GROUP", "fx_rate",
             when=f"fx_rate IS NULL AND currency = '{c}'", value="{" + f"fx_{c}" + "}",
             stats=(Stat(f"fx_{c}", "quantile", "fx_rate", 0.5, f"currency = '{c}'"),))
        for c in FX_CURRENCIES
    ]
    money = ("debit_amount", "credit_amount", "net_amount")
    return Domain(
        "ledger",
        ("transaction_id",),
        tuple(order_by),
        [
            _dedupe("transaction_id"),
            _positive("debit_amount", "NEGATIVE_DEBIT"),
            Rule("LOGIC_VIOLATION", "derive", "RECOMPUTE", "net_amount",
                 when="abs(net_amount - (debit_amount - credit_amount)) > 0.01D",
                 value="debit_amount - credit_amount"),
            *[Rule("PRECISION_2DP", "round", "ROUND_2DP", c, fn="round2") for c in money],
            _future("posting_date", as_of, "FUTURE_DATE"),
            _flag("LAG", "flag", "effective_date", "timestampdiff(DAY, effective_date, posting_date) > 365",
                  "UNUSUAL_LAG_365D"),
            _flag("APPROVAL_ORDER", "flag", "approval_date", "approval_date < posting_date",
                  "APPROVED_BEFORE_POSTED"),
            *fx,
            Rule("FORMAT_STANDARDISE", "text", "STANDARDIZE", "account_code", fn="account_code"),
            _map("approval_status", APPROVAL),
            _flag("FK_VIOLATION", "reference", "vendor_id", orphan, "ORPHANED_FK"),
            _flag("JOURNAL_BALANCE", "reference", "journal_entry_id", "_off_journal", "IMBALANCED_JOURNAL"),
            _flag("INTERCOMPANY", "reference", "intercompany_flag", "_off_intercompany",
                  "INTERCOMPANY_IMBALANCE", flag="ic_unbalanced_flag"),
        ],
        [
            Check("null_fx_rate", "completeness", "WARNING", "fx_rate", "fx_rate IS NULL AND currency <> 'USD'"),
            Check("excess_precision", "validity", "INFO", "debit_amount",
                  "abs(debit_amount - round(debit_amount, 2)) > 1e-9"),
            Check("negative_debit", "validity", "CRITICAL", "debit_amount", "debit_amount < 0"),
            Check("mixed_account_code", "consistency", "WARNING", "account_code", fn="account_code"),
            Check("mixed_approval", "consistency", "WARNING", "approval_status", fn="map",
                  args={"mapping": APPROVAL}),
            Check("orphan_vendor", "consistency", "WARNING", "vendor_id", orphan),
            Check("imbalanced_journal", "accuracy", "CRITICAL", "journal_entry_id", "_off_journal"),
            Check("net_amount_break", "accuracy", "CRITICAL", "net_amount",
                  "abs(net_amount - (debit_amount - credit_amount)) > 0.01D"),
            Check("approved_before_posted", "accuracy", "WARNING", "approval_date",
                  "approval_date < posting_date"),
        ],
        [Reference("vendor_id", "vendors", vendors, "_orphan_vendor")] if vendors else [],
        [
            Balance("journal_entry_id", "debit_amount", "credit_amount", "_off_journal"),
            Balance("journal_entry_id", "debit_amount", "credit_amount", "_off_intercompany",
                    where="intercompany_flag = 1"),
        ],
    )


def catalog(rates: dict[str, float] | None = None, languages: dict[str, str] | None = None) -> Domain:
    """``languages`` names the language each text column should be in."""
    languages = LANGUAGES if languages is None else languages
    rate = (rates or {"EUR": 0.92})["EUR"]
    weight = f"abs(weight_lbs - weight_kg * {LBS_PER_KG}D) > 0.01D"
    stale = f"abs(price_eur - abs(price_usd) * {rate}D) > 0.01D"
    unknown = [
        Rule(f"NULL_{c}", "impute", "IMPUTE_UNKNOWN", c, when=f"{c} IS NULL", value="'UNKNOWN'")
        for c in ("product_name_hi", "product_name_ja")
    ]
    return Domain(
        "catalog",
        ("product_id",),
        ("row_seq",),
        [
            _dedupe("product_id"),
            _null_money("price_usd"),
            _positive("price_usd", "CONVERTED_NEGATIVE"),
            Rule("CAP_RANGE", "bounds", "CAP_RANGE", "margin_pct", fn="clip", args={"lo": -50.0, "hi": 100.0}),
            _floor_zero("stock_quantity"),
            _sequence("created_at", "published_at"),
            _map("category_l1", CATEGORY),
            Rule("STRIP_HTML", "text", "STRIP_HTML", "description_en", fn="strip_html"),
            *[
                Rule("WRONG_LANGUAGE", "flag", "FLAG", c, test="wrong_language", args={"lang": lang}, flag=f"{c}_flag",
                     label="WRONG_LANGUAGE")
                for c, lang in languages.items()
            ],
            *unknown,
            Rule("UNIT_WEIGHT", "logic", "RECOMPUTE", "weight_lbs", when=weight,
                 value=f"weight_kg * {LBS_PER_KG}D"),
            _flag("STALE_FX", "logic", "price_eur", stale, "STALE_FX"),
        ],
        [
            Check("null_price_usd", "completeness", "WARNING", "price_usd", "price_usd IS NULL"),
            Check("missing_hi", "completeness", "INFO", "product_name_hi", "product_name_hi IS NULL"),
            Check("missing_ja", "completeness", "INFO", "product_name_ja", "product_name_ja IS NULL"),
            Check("negative_price", "validity", "CRITICAL", "price_usd", "price_usd < 0"),
            Check("margin_range", "validity", "CRITICAL", "margin_pct", "margin_pct < -50 OR margin_pct > 100"),
            Check("markup", "validity", "WARNING", "description_en", "description_en RLIKE '<[^>]+>'"),
            Check("negative_stock", "validity", "INFO", "stock_quantity", "stock_quantity < 0"),
            Check("mixed_category", "consistency", "WARNING", "category_l1", fn="map", args={"mapping": CATEGORY}),
            *[
                Check(f"wrong_language_{c}", "consistency", "WARNING", c, test="wrong_language", args={"lang": lang})
                for c, lang in languages.items()
            ],
            Check("weight_units", "accuracy", "WARNING", "weight_lbs", weight),
            Check("stale_rate", "accuracy", "WARNING", "price_eur", stale),
            Check("published_before_created", "accuracy", "CRITICAL", "published_at",
                  "published_at < created_at"),
        ],
    )


DOMAINS = {
    "orders": orders,
    "telemetry": telemetry,
    "workforce": workforce,
    "ledger": ledger,
    "catalog": catalog,
}
