"""Issue detection queries (section D)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnish.dirty import dirty, table
from burnish.operators import detect as D
from burnish.operators import profile as P
from burnish.operators import trigrams as G
from burnish.operators.actions import outlier_share
from burnish.operators.language import guess_language, wrong_language
from burnish.plans.engine import group_imbalance
from burnish.plans.rules import Balance
from burnish.plans.score import with_marks
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
    cleaned,
    ctes,
    domain,
    query,
    raw,
)
from burnish.session import materialise
from burnish.registry.profiles import union

KEYS = {
    "orders": ["row_seq"],
    "telemetry": ["row_seq"],
    "workforce": ["row_seq"],
    "ledger": ["transaction_id", "l_partkey", "l_suppkey"],
    "catalog": ["row_seq"],
}


def rows_where(name: str, view: str, predicate, sql: str, *show: str) -> None:
    """Rows on which a detector fires, with the columns it looked at."""
    cols = [*KEYS[view], *show]

    def run(spark, sf_dir) -> DataFrame:
        return raw(spark, sf_dir, view).filter(predicate()).select(*cols)

    query(name, ctes(f"dirty_{view}") + f"SELECT {', '.join(cols)} FROM dirty_{view} WHERE {sql}")(run)


SINGLE = {"orders": "order_id", "workforce": "employee_id", "ledger": "transaction_id", "catalog": "product_id"}


@query(
    "d1_dup_key_count",
    ctes(*[f"dirty_{n}" for n in SINGLE])
    + union(
        [f"SELECT '{n}' AS table_name, count(*) - count(DISTINCT {k}) AS extra_copies FROM dirty_{n}" for n, k in SINGLE.items()]
    ),
)
def _dup_keys(spark, sf_dir):
    pieces = [
        D.dup_key_count(raw(spark, sf_dir, n), [k]).select(F.lit(n).alias("table_name"), "extra_copies")
        for n, k in SINGLE.items()
    ]
    return reduce(DataFrame.unionByName, pieces)


@query(
    "d2_dup_key_count_composite",
    ctes("dirty_telemetry")
    + "SELECT count(*) - (SELECT count(*) FROM (SELECT DISTINCT device_id, reading_timestamp FROM dirty_telemetry)) AS extra_copies FROM dirty_telemetry",
)
def _dup_composite(spark, sf_dir):
    return D.dup_key_count(raw(spark, sf_dir, "telemetry"), ["device_id", "reading_timestamp"])


@query(
    "d3_dup_listing",
    ctes("dirty_ledger")
    + "SELECT transaction_id, count(*) AS cnt FROM dirty_ledger GROUP BY 1 HAVING count(*) > 1 ORDER BY 2 DESC, 1 LIMIT 10",
)
def _dup_listing(spark, sf_dir):
    return D.dup_listing(raw(spark, sf_dir, "ledger"), ["transaction_id"], 10)


rows_where("d4_null_key", "workforce", lambda: D.null_key(F.col("manager_id")), "manager_id IS NULL")
rows_where(
    "d5_sequence_break_orders", "orders", lambda: D.sequence_break(F.col("onboarding_date"), F.col("go_live_date")),
    "onboarding_date > go_live_date",
)
rows_where(
    "d5_sequence_break_telemetry", "telemetry",
    lambda: D.sequence_break(F.col("reading_timestamp"), F.col("ingestion_timestamp")),
    "ingestion_timestamp < reading_timestamp",
)
rows_where(
    "d5_sequence_break_workforce", "workforce", lambda: D.sequence_break(F.col("hire_date"), F.col("termination_date")),
    "termination_date IS NOT NULL AND termination_date < hire_date",
)
rows_where(
    "d5_sequence_break_catalog", "catalog", lambda: D.sequence_break(F.col("created_at"), F.col("published_at")),
    "published_at < created_at",
)
rows_where(
    "d6_future_date", "orders", lambda: D.future_date(F.col("go_live_date"), AS_OF), f"go_live_date > TIMESTAMP '{AS_OF}'"
)
rows_where(
    "d7_legacy_date", "orders", lambda: D.legacy_date(F.col("order_date"), "1995-02-01"),
    "order_date < TIMESTAMP '1995-02-01'",
)
rows_where("d8_negative_money", "orders", lambda: D.negative(F.col("order_amount")), "order_amount < 0", "order_amount")
rows_where("d8_negative_number", "catalog", lambda: D.negative(F.col("stock_quantity")), "stock_quantity < 0", "stock_quantity")


@query(
    "d9_null_rate",
    ctes("dirty_workforce")
    + union(
        [
            f"SELECT '{c}' AS column_name, round((count(*) - count({c})) * 100 / count(*), 6) AS null_pct FROM dirty_workforce"
            for c in ["manager_id", "full_name", "bonus_target", "equity_grant", "hire_date"]
        ]
    ),
)
def _null_rate(spark, sf_dir):
    cols = ["manager_id", "full_name", "bonus_target", "equity_grant", "hire_date"]
    return P.null_rate(raw(spark, sf_dir, "workforce"), cols).withColumn("null_pct", F.round("null_pct", 6))


rows_where(
    "d10_out_of_range_temperature", "telemetry", lambda: D.out_of_range(F.col("temperature_c"), -50, 500),
    "temperature_c > 500 OR temperature_c < -50", "temperature_c",
)
rows_where(
    "d10_out_of_range_efficiency", "telemetry", lambda: D.out_of_range(F.col("efficiency_pct"), hi=100),
    "efficiency_pct > 100", "efficiency_pct",
)
rows_where(
    "d10_out_of_range_rating", "workforce", lambda: D.out_of_range(F.col("perf_rating_2024"), 1, 5),
    "perf_rating_2024 < 1 OR perf_rating_2024 > 5", "perf_rating_2024",
)
rows_where(
    "d10_out_of_range_margin", "catalog", lambda: D.out_of_range(F.col("margin_pct"), -50, 100),
    "margin_pct < -50 OR margin_pct > 100", "margin_pct",
)
rows_where("d11_bad_email", "orders", lambda: D.bad_email(F.col("email")), f"NOT {EMAIL}", "email")
rows_where("d12_padded", "workforce", lambda: D.padded(F.col("full_name")), "full_name <> trim(full_name)", "full_name")


def _mixed(name: str, view: str, column: str) -> None:
    @query(
        name,
        ctes(f"dirty_{view}")
        + f"SELECT upper(trim({column})) AS canonical, count(DISTINCT {column}) AS variants, count(*) AS rows FROM dirty_{view} "
        f"WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT {column}) > 1",
    )
    def _run(spark, sf_dir):
        return D.mixed_category(raw(spark, sf_dir, view), column)


_mixed("d13_mixed_category_status", "orders", "status")
_mixed("d13_mixed_category_department", "workforce", "department")
_mixed("d13_mixed_category_device", "telemetry", "device_type")
_mixed("d13_mixed_category_approval", "ledger", "approval_status")


@query(
    "d14_orphan_fk_customer",
    ctes("dirty_orders")
    + "SELECT customer_id, count(*) AS rows FROM dirty_orders WHERE customer_id NOT IN (SELECT c_custkey FROM customer) GROUP BY 1",
)
def _orphan_customer(spark, sf_dir):
    return D.orphan_fk(raw(spark, sf_dir, "orders"), "customer_id", table(spark, sf_dir, "customer"), "c_custkey")


@query(
    "d14_orphan_fk_manager",
    ctes("dirty_workforce")
    + "SELECT manager_id, count(*) AS rows FROM dirty_workforce WHERE manager_id IS NOT NULL "
    "AND manager_id NOT IN (SELECT employee_id FROM dirty_workforce) GROUP BY 1",
)
def _orphan_manager(spark, sf_dir):
    df = raw(spark, sf_dir, "workforce")
    return D.orphan_fk(df, "manager_id", df, "employee_id")


@query(
    "d14_orphan_fk_lineitem",
    "SELECT l_orderkey, count(*) AS rows FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders) GROUP BY 1",
)
def _orphan_lineitem(spark, sf_dir):
    return D.orphan_fk(table(spark, sf_dir, "lineitem"), "l_orderkey", table(spark, sf_dir, "orders"), "o_orderkey")


rows_where(
    "d15_orphan_pattern_suffix", "orders", lambda: D.orphan_pattern(F.col("order_id"), above=9500),
    "TRY_CAST(split_part(order_id, '-', 2) AS BIGINT) > 9500", "order_id",
)
rows_where(
    "d15_orphan_pattern_text", "catalog", lambda: D.orphan_pattern(F.col("category_l1"), text="Elec"),
    "contains(category_l1, 'Elec')", "category_l1",
)
rows_where(
    "d16_identity_break_net", "ledger",
    lambda: D.identity_break(F.col("net_amount"), F.col("debit_amount") - F.col("credit_amount"), 0.01),
    "abs(net_amount - (debit_amount - credit_amount)) > 1e-2", "net_amount",
)
rows_where(
    "d16_identity_break_arr", "orders", lambda: D.shortfall(F.col("arr"), F.col("mrr") * 12),
    "arr < mrr * 12 * (1 - 1e-9)", "arr", "mrr",
)
rows_where(
    "d16_identity_break_comp", "workforce", lambda: F.col("total_comp") < F.abs("base_salary"),
    "total_comp < abs(base_salary)", "total_comp",
)
rows_where(
    "d17_physics_break", "telemetry",
    lambda: D.physics_break(F.col("power_kw"), F.col("voltage_v"), F.col("current_a")),
    "power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9)", "power_kw",
)
rows_where(
    "d17_physics_break_strict", "telemetry",
    lambda: D.physics_break(F.col("power_kw"), F.col("voltage_v"), F.col("current_a"), 1.0),
    "power_kw > voltage_v * current_a", "power_kw",
)
rows_where(
    "d18_conditional_value", "telemetry",
    lambda: D.conditional_value(F.col("vibration_hz"), 0, F.col("device_status") == "running"),
    "vibration_hz = 0 AND device_status = 'running'",
)
rows_where(
    "d19_above_band", "workforce", lambda: D.above_band(F.abs("base_salary"), F.col("salary_band_max")),
    "abs(base_salary) > salary_band_max", "base_salary",
)
rows_where(
    "d20_over_balance", "workforce", lambda: D.over_balance(F.col("pto_days_used"), F.col("pto_days_remaining")),
    "pto_days_used > pto_days_used + pto_days_remaining", "pto_days_used", "pto_days_remaining",
)


@query(
    "d21_group_imbalance",
    ctes("dirty_ledger")
    + "SELECT journal_entry_id, round(sum(debit_amount) - sum(credit_amount), 4) AS difference FROM dirty_ledger GROUP BY 1 "
    "HAVING abs(sum(debit_amount) - sum(credit_amount)) > 1e-2",
)
def _imbalance(spark, sf_dir):
    found = group_imbalance(
        raw(spark, sf_dir, "ledger"), Balance("journal_entry_id", "debit_amount", "credit_amount", "off")
    )
    return found.withColumn("difference", F.round("difference", 4))


@query(
    "d22_group_imbalance_intercompany",
    ctes("dirty_ledger")
    + "SELECT journal_entry_id, round(sum(debit_amount) - sum(credit_amount), 4) AS difference FROM dirty_ledger "
    "WHERE intercompany_flag = 1 GROUP BY 1 HAVING abs(sum(debit_amount) - sum(credit_amount)) > 1e-2",
)
def _imbalance_ic(spark, sf_dir):
    rule = Balance("journal_entry_id", "debit_amount", "credit_amount", "off", where="intercompany_flag = 1")
    return group_imbalance(raw(spark, sf_dir, "ledger"), rule).withColumn("difference", F.round("difference", 4))


rows_where(
    "d23_lag_over", "ledger", lambda: D.lag_over(F.col("effective_date"), F.col("posting_date"), 365),
    "date_sub('day', effective_date, posting_date) > 365",
)
rows_where(
    "d24_sequence_break_approval", "ledger", lambda: D.sequence_break(F.col("posting_date"), F.col("approval_date")),
    "approval_date < posting_date",
)
rows_where(
    "d25_excess_precision", "ledger", lambda: D.excess_precision(F.col("debit_amount")),
    "abs(debit_amount - round(debit_amount, 2)) > 1e-9", "debit_amount",
)
rows_where("d26_has_markup", "catalog", lambda: D.has_markup(F.col("description_en")),
           "regexp_matches(description_en, '<[^>]+>')", "description_en")


@query("d26_has_markup_pages", "SELECT page_id FROM pages WHERE regexp_matches(html, '<[^>]+>')")
def _markup_pages(spark, sf_dir):
    return table(spark, sf_dir, "pages").filter(D.has_markup(F.col("html"))).select("page_id")


@query(
    "d27_bad_encoding",
    r"SELECT doc_id FROM documents WHERE regexp_matches(text, '[\x{0080}-\x{009F}\x{FFFD}]')",
)
def _encoding(spark, sf_dir):
    return table(spark, sf_dir, "documents").filter(D.bad_encoding(F.col("text"))).select("doc_id")


def _words(lang: str) -> str:
    from burnish.operators.language import FUNCTION_WORDS

    words = ", ".join(f"'{w}'" for w in FUNCTION_WORDS[lang])
    return f"len(list_filter(string_split_regex(lower(text), '[^\\p{{L}}]+'), lambda w: w IN ({words})))"


_GUESS = (
    "CASE WHEN greatest(de, en, es, fr) = 0 THEN NULL WHEN de = greatest(de, en, es, fr) THEN 'de' "
    "WHEN en = greatest(de, en, es, fr) THEN 'en' WHEN es = greatest(de, en, es, fr) THEN 'es' ELSE 'fr' END"
)


@query(
    "d28_wrong_language",
    f"SELECT doc_id, lang, {_GUESS} AS guess, coalesce({_GUESS} <> lang, false) AS wrong FROM "
    f"(SELECT doc_id, lang, {_words('de')} AS de, {_words('en')} AS en, {_words('es')} AS es, {_words('fr')} AS fr FROM documents)",
)
def _language(spark, sf_dir):
    text = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", "lang", guess_language(text).alias("guess"), wrong_language(text, F.col("lang")).alias("wrong")
    )


# Words of six letters and more stand for names; some are declared in another language than their text's.
_NAMES = (
    "SELECT word AS value, CASE WHEN length(word) % 7 = 0 AND word < 'e' THEN CASE lang WHEN 'en' THEN 'de' WHEN 'de' THEN 'fr' WHEN 'fr' THEN 'es' ELSE 'en' END ELSE lang END AS label "
    "FROM ({words}) WHERE length(word) >= 6 AND lang IS NOT NULL"
)
_PADDED = "concat(' ', trim(regexp_replace(lower(value), '[^\\p{L}\\p{M}]+', ' ', 'g')), ' ')"


@query(
    "d28_wrong_language_names",
    f"""
WITH named AS ({_NAMES.format(words="SELECT lang, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS word FROM documents")}),
vals AS (SELECT label, value, count(*) AS n, {_PADDED} AS p FROM named GROUP BY ALL),
grams AS (SELECT label, value, n, substr(p, i, 3) AS gram FROM (SELECT *, unnest(generate_series(1, length(p) - 2)) AS i FROM vals WHERE length(p) > 2)),
counts AS (SELECT label, gram, CAST(sum(n) AS BIGINT) AS n FROM grams GROUP BY ALL),
totals AS (SELECT label, 2 * sum(n) + (SELECT count(DISTINCT gram) FROM counts) AS wide FROM counts GROUP BY label),
floors AS (SELECT label, wide, CAST(round(ln(1e0 / CAST(wide AS DOUBLE)) * 1000) AS BIGINT) AS floor FROM totals),
gains AS (SELECT c.label, gram, CAST(round(ln(CAST(2 * n + 1 AS DOUBLE) / CAST(wide AS DOUBLE)) * 1000) AS BIGINT) - floor AS gain FROM counts c JOIN floors USING (label)),
texts AS (SELECT DISTINCT value, gram, pos FROM (SELECT value, substr(p, i, 3) AS gram, i AS pos FROM (SELECT DISTINCT value, p, unnest(generate_series(1, length(p) - 2)) AS i FROM vals WHERE length(p) > 2))),
scores AS (
  SELECT value, f.label, sum(floor + coalesce(gain, 0)) AS score
  FROM texts CROSS JOIN floors f LEFT JOIN gains g ON g.label = f.label AND g.gram = texts.gram GROUP BY value, f.label),
best AS (SELECT value, first(label ORDER BY score DESC, label) AS guess, max(score) AS top FROM scores GROUP BY value)
SELECT v.label, v.value, v.n, CASE WHEN s.score IS NOT NULL THEN guess END AS guess, CAST(top - s.score AS BIGINT) AS lead, coalesce(top - s.score > 3000, false) AS wrong
FROM vals v LEFT JOIN best USING (value) LEFT JOIN scores s ON s.value = v.value AND s.label = v.label""",
)
def _names(spark, sf_dir):
    """Trigram model over single words, some declared in the wrong language."""
    # The same letters as the SQL's, listed: a negated class of ranges takes ten times as long.
    found = F.regexp_extract_all("text", F.lit(r"[A-Za-z\x{80}-\x{10FFFF}]++"), F.lit(0))
    words = F.explode(F.filter(found, lambda word: F.length(word) >= 6)).alias("word")
    named = spark.sql(_NAMES.replace("({words})", "{words}"), words=table(spark, sf_dir, "documents").select("lang", words))
    values = materialise(G.distinct_values(named, "value", "label"), "names")
    return G.judge(values, *G.learn(values))


rows_where(
    "d29_unit_break", "catalog", lambda: D.unit_break(F.col("weight_kg"), F.col("weight_lbs"), 2.205),
    "abs(weight_lbs - weight_kg * 2205e-3) > 1e-2", "weight_lbs",
)
rows_where(
    "d30_stale_rate", "catalog", lambda: D.stale_rate(F.abs("price_usd"), F.col("price_eur"), 0.92),
    "abs(price_eur - abs(price_usd) * 92e-2) > 1e-2", "price_eur",
)


@query(
    "d31_large_value",
    ctes("dirty_orders")
    + "SELECT row_seq, total_amount FROM dirty_orders WHERE total_amount > (SELECT quantile_cont(total_amount, 0.75) + "
    "3 * (quantile_cont(total_amount, 0.75) - quantile_cont(total_amount, 0.25)) FROM dirty_orders)",
)
def _large(spark, sf_dir):
    df = raw(spark, sf_dir, "orders")
    bound, _ = outlier_share(df, "total_amount")
    return df.filter(D.large_value(F.col("total_amount"), bound)).select("row_seq", "total_amount")


# Row checks of the orders table in SQL: (issue, column, dimension, severity, condition).
ORDER_CHECKS = [
    ("null_customer_name", "customer_name", "completeness", "WARNING", "customer_name IS NULL"),
    ("null_nps_score", "nps_score", "completeness", "INFO", "nps_score IS NULL"),
    ("null_health_score", "health_score", "completeness", "INFO", "health_score IS NULL"),
    ("null_order_amount", "order_amount", "completeness", "CRITICAL", "order_amount IS NULL"),
    ("malformed_email", "email", "validity", "WARNING", f"NOT {EMAIL}"),
    ("negative_seats_used", "seats_used", "validity", "WARNING", "seats_used < 0"),
    ("negative_order_amount", "order_amount", "validity", "CRITICAL", "order_amount < 0"),
    ("arr_below_mrr", "arr", "consistency", "CRITICAL", "arr < mrr * 12 * (1 - 1e-9)"),
    ("mixed_status", "status", "consistency", "WARNING", f"status <> {STATUS}"),
    ("mixed_industry", "industry", "consistency", "WARNING", f"industry <> {INDUSTRY}"),
    ("orphan_customer", "customer_id", "consistency", "CRITICAL", "customer_id >= 1000000000"),
    ("onboarding_after_go_live", "onboarding_date", "accuracy", "CRITICAL", "onboarding_date > go_live_date"),
    ("future_order_date", "order_date", "accuracy", "WARNING", f"order_date > TIMESTAMP '{AS_OF}'"),
    ("legacy_order_date", "order_date", "accuracy", "INFO", f"order_date < TIMESTAMP '{LEGACY}'"),
]


def issues_sql(source: str) -> str:
    return union(
        [
            f"SELECT '{n}' AS issue, '{c}' AS column_name, '{d}' AS dimension, '{s}' AS severity, "
            f"CAST(count(*) FILTER ({e}) AS BIGINT) AS issue_rows, round(count(*) FILTER ({e}) * 100 / count(*), 2) AS pct FROM {source}"
            for n, c, d, s, e in ORDER_CHECKS
        ]
    )


def summary_sql(source: str) -> str:
    return (
        f"SELECT severity, count(*) AS issues, CAST(sum(issue_rows) AS BIGINT) AS issue_rows FROM ({issues_sql(source)}) "
        "WHERE issue_rows > 0 GROUP BY severity"
    )


@query("d32_detect_issues", ctes("dirty_orders") + issues_sql("dirty_orders"))
def _issues(spark, sf_dir):
    return D.detect_issues(raw(spark, sf_dir, "orders"), domain("orders").checks)


@query("d32_issue_summary", ctes("dirty_orders") + summary_sql("dirty_orders"))
def _issue_summary(spark, sf_dir):
    return D.issue_summary(D.detect_issues(raw(spark, sf_dir, "orders"), domain("orders").checks))


@query(
    "d33_affected_rows",
    ctes("dirty_orders")
    + "SELECT count(*) AS total_rows, count(*) FILTER ("
    + " OR ".join(f"coalesce({e}, false)" for *_, e in ORDER_CHECKS)
    + ") AS affected_rows FROM dirty_orders",
)
def _affected(spark, sf_dir):
    return D.affected_rows(raw(spark, sf_dir, "orders"), domain("orders").checks)


@query(
    "d34_issue_overview",
    ctes("dirty_orders", "clean_orders")
    + union(
        [
            f"SELECT 'orders' AS table_name, '{layer}' AS layer, * FROM ({summary_sql(source)})"
            for layer, source in (("RAW", "dirty_orders"), ("CLEANED", "clean_orders"))
        ]
    ),
)
def _overview(spark, sf_dir):
    checks = domain("orders").checks
    return D.issue_overview(
        {
            ("orders", "RAW"): D.detect_issues(raw(spark, sf_dir, "orders"), checks),
            ("orders", "CLEANED"): D.detect_issues(cleaned(spark, sf_dir, "orders"), checks),
        }
    )


# (severity, condition) of the other tables' checks; {t} is the layer's table.
_JOURNAL = "journal_entry_id IN (SELECT journal_entry_id FROM {t} GROUP BY 1 HAVING abs(sum(debit_amount) - sum(credit_amount)) > 1e-2)"
OTHER_CHECKS = {
    "telemetry": [
        ("CRITICAL", "torque_nm IS NULL"), ("INFO", "predicted_failure_days IS NULL"),
        ("CRITICAL", "temperature_c > 500 OR temperature_c < -50"), ("CRITICAL", "pressure_psi < 0"), ("WARNING", "efficiency_pct > 100"),
        ("CRITICAL", "power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9)"), ("WARNING", f"firmware_version <> {FIRMWARE}"),
        ("WARNING", f"device_type <> {DEVICE}"), ("WARNING", "vibration_hz = 0 AND device_status = 'running'"),
        ("CRITICAL", "ingestion_timestamp < reading_timestamp"), ("WARNING", f"reading_timestamp > TIMESTAMP '{AS_OF_EVENTS}'"),
    ],
    "workforce": [
        ("INFO", "bonus_target IS NULL"), ("INFO", "equity_grant IS NULL"), ("WARNING", "full_name IS NULL"), ("CRITICAL", "base_salary < 0"),
        ("WARNING", f"NOT {EMAIL}"), ("WARNING", "perf_rating_2024 < 1 OR perf_rating_2024 > 5"), ("WARNING", f"department <> {DEPARTMENT}"),
        ("WARNING", f"employment_status <> {EMPLOYMENT}"),
        ("CRITICAL", "manager_id IS NOT NULL AND manager_id NOT IN (SELECT employee_id FROM {t})"), ("CRITICAL", "hire_date > termination_date"),
        ("WARNING", f"hire_date > TIMESTAMP '{AS_OF}'"), ("CRITICAL", "total_comp < base_salary"), ("WARNING", "base_salary > salary_band_max"),
    ],
    "ledger": [
        ("WARNING", "fx_rate IS NULL AND currency <> 'USD'"), ("INFO", "abs(debit_amount - round(debit_amount, 2)) > 1e-9"),
        ("CRITICAL", "debit_amount < 0"), ("WARNING", f"account_code <> {CODE}"), ("WARNING", f"approval_status <> {APPROVAL}"),
        ("WARNING", "vendor_id >= 1000000000"), ("CRITICAL", _JOURNAL), ("CRITICAL", "abs(net_amount - (debit_amount - credit_amount)) > 1e-2"),
        ("WARNING", "approval_date < posting_date"),
    ],
    "catalog": [
        ("WARNING", "price_usd IS NULL"), ("INFO", "product_name_hi IS NULL"), ("INFO", "product_name_ja IS NULL"), ("CRITICAL", "price_usd < 0"),
        ("CRITICAL", "margin_pct < -50 OR margin_pct > 100"), ("WARNING", "regexp_matches(description_en, '<[^>]+>')"),
        ("INFO", "stock_quantity < 0"), ("WARNING", f"category_l1 <> {CATEGORY}"), ("WARNING", NOT_HINDI), ("WARNING", NOT_JAPANESE),
        ("WARNING", "abs(weight_lbs - weight_kg * 2205e-3) > 1e-2"), ("WARNING", "abs(price_eur - abs(price_usd) * 92e-2) > 1e-2"),
        ("CRITICAL", "published_at < created_at"),
    ],
}


def _severities(name: str, layer: str, source: str) -> str:
    found = union([f"SELECT '{s}' AS severity, count(*) FILTER ({e.replace('{t}', source)}) AS issue_rows FROM {source}" for s, e in OTHER_CHECKS[name]])
    return (
        f"SELECT '{name}' AS table_name, '{layer}' AS layer, severity, count(*) AS issues, CAST(sum(issue_rows) AS BIGINT) AS issue_rows "
        f"FROM ({found}) WHERE issue_rows > 0 GROUP BY severity"
    )


_LAYERS = (("RAW", "dirty_"), ("CLEANED", "clean_"))


@query(
    "d34_issue_overview_all",
    ctes(*[f"{p}{n}" for n in VIEW_NAMES for _, p in _LAYERS])
    + union([f"SELECT 'orders' AS table_name, '{layer}' AS layer, * FROM ({summary_sql(p + 'orders')})" for layer, p in _LAYERS])
    + " UNION ALL "
    + union([_severities(n, layer, p + n) for n in OTHER_CHECKS for layer, p in _LAYERS]),
)
def _overview_all(spark, sf_dir):
    """Both layers of all five tables, reference and balance marks included."""
    found = {}
    for name in VIEW_NAMES:
        d = domain(name)
        df = dirty(spark, sf_dir, name)
        for layer, frame in (("RAW", df), ("CLEANED", d.clean(df).frame)):
            found[(name, layer)] = D.detect_issues(with_marks(frame, d), d.checks)
    return D.issue_overview(found)


