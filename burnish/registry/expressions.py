"""Column functions over whole tables and views (section B)."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnish.dirty import dirty
from burnish.functions import numbers as N
from burnish.functions import text as X
from burnish.operators.actions import delete_where
from burnish.plans.domains import INDUSTRY, STATUS
from burnish.registry.base import (
    AS_OF,
    CATEGORY,
    CODE,
    EMAIL,
    FIRMWARE,
    LOWERED_EMAIL,
    STRIPPED,
    ctes,
    half_up,
    project,
    query,
)
from burnish.registry.base import STATUS as STATUS_SQL


def _c(*names: str):
    return [F.col(n) for n in names]


project(
    "b1_trim_ws", "orders",
    lambda: [*_c("row_seq"), X.trim_ws(F.col("customer_name")).alias("trimmed")],
    r"row_seq, regexp_replace(customer_name, '^\s+|\s+$', '', 'g') AS trimmed",
)
project(
    "b2_upper_lower", "orders",
    lambda: [*_c("row_seq"), X.upper(F.col("status")).alias("up"), X.lower(F.col("email")).alias("low")],
    "row_seq, upper(status) AS up, lower(email) AS low",
)
project(
    "b3_map_values", "orders",
    lambda: [
        *_c("row_seq"),
        X.map_values(F.col("status"), STATUS).alias("status"),
        X.map_values(F.col("industry"), {"SaaS": "SAAS"}).alias("industry"),
    ],
    f"row_seq, {STATUS_SQL} AS status, CASE WHEN industry = 'SaaS' THEN 'SAAS' ELSE upper(industry) END AS industry",
)
project(
    "b4_valid_email", "orders",
    lambda: [*_c("row_seq", "email"), X.valid_email(F.col("email")).alias("valid")],
    f"row_seq, email, {EMAIL} AS valid",
)
project(
    "b5_like_email", "orders",
    lambda: [*_c("row_seq"), X.like_email(F.col("email")).alias("looks_valid")],
    "row_seq, email LIKE '%@%.%' AS looks_valid",
)
project(
    "b6_matches", "ledger",
    lambda: [*_c("transaction_id", "l_partkey", "l_suppkey", "account_code"),
             X.matches(F.col("account_code"), "^[0-9]{4}$").alias("four_digits"),
             X.matches(F.col("account_code"), "^[A-Z]{2}-[0-9]{4}$").alias("prefixed")],
    "transaction_id, l_partkey, l_suppkey, account_code, regexp_matches(account_code, '^[0-9]{4}$') AS four_digits, "
    "regexp_matches(account_code, '^[A-Z]{2}-[0-9]{4}$') AS prefixed",
)
project(
    "b7_strip_tags", "pages",
    lambda: [*_c("page_id"), X.strip_tags(F.col("html")).alias("plain")],
    r"page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '^\s+|\s+$', '', 'g') AS plain",
)
project(
    "b8_has_text", "catalog",
    lambda: [*_c("row_seq"), X.has_text(F.col("description_en"), "<").alias("found")],
    "row_seq, contains(description_en, '<') AS found",
)
project(
    "b9_starts_replace", "telemetry",
    lambda: [*_c("row_seq"), X.starts(F.col("firmware_version"), "v").alias("has_v"),
             X.replace_text(F.col("firmware_version"), "_", ".").alias("dotted")],
    "row_seq, starts_with(firmware_version, 'v') AS has_v, replace(firmware_version, '_', '.') AS dotted",
)
project(
    "b10_zfill_trunc", "ledger",
    lambda: [*_c("transaction_id", "l_partkey", "l_suppkey"),
             X.zfill_trunc(F.col("l_suppkey").cast("string"), 4).alias("padded"),
             X.zfill_trunc(F.col("account_code"), 4).alias("cut")],
    "transaction_id, l_partkey, l_suppkey, "
    "CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 4 THEN lpad(CAST(l_suppkey AS VARCHAR), 4, '0') ELSE substr(CAST(l_suppkey AS VARCHAR), 1, 4) END AS padded, "
    "CASE WHEN length(account_code) < 4 THEN lpad(account_code, 4, '0') ELSE substr(account_code, 1, 4) END AS cut",
)
project(
    "b11_id_suffix", "orders",
    lambda: [*_c("order_id", "row_seq"), X.id_suffix(F.col("order_id")).cast("bigint").alias("suffix")],
    "order_id, row_seq, TRY_CAST(split_part(order_id, '-', 2) AS BIGINT) AS suffix",
)
project(
    "b12_abs_value", "workforce",
    lambda: [*_c("row_seq"), N.abs_value(F.col("base_salary")).alias("salary"), (-F.col("total_comp")).alias("negated")],
    "row_seq, abs(base_salary) AS salary, -total_comp AS negated",
)
project(
    "b13_round2", "ledger",
    lambda: [*_c("transaction_id", "l_partkey", "l_suppkey"), N.round2(F.col("debit_amount")).alias("rounded")],
    f"transaction_id, l_partkey, l_suppkey, {half_up('debit_amount')} AS rounded",
)
project(
    "b14_clip", "catalog",
    lambda: [*_c("row_seq"), N.clip(F.col("margin_pct"), -50, 100).alias("margin"), N.clip(F.col("price_usd"), 0, 1000).alias("price")],
    "row_seq, CASE WHEN margin_pct IS NOT NULL THEN greatest(-50, least(100, margin_pct)) END AS margin, "
    "CASE WHEN price_usd IS NOT NULL THEN greatest(0, least(1000, price_usd)) END AS price",
)
project(
    "b15_fill", "catalog",
    lambda: [*_c("row_seq"), N.fill(F.col("product_name_hi"), "UNKNOWN").alias("name_hi"), N.fill(F.col("price_usd"), 0.0).alias("price")],
    "row_seq, coalesce(product_name_hi, 'UNKNOWN') AS name_hi, coalesce(price_usd, 0) AS price",
)
project(
    "b16_days_between", "telemetry",
    lambda: [*_c("row_seq"), N.days_between(F.col("reading_timestamp"), F.lit(AS_OF).cast("timestamp_ntz")).alias("days")],
    f"row_seq, date_sub('day', reading_timestamp, TIMESTAMP '{AS_OF}') AS days",
)
project(
    "b17_is_future", "orders",
    lambda: [*_c("row_seq"), N.is_future(F.col("go_live_date"), AS_OF).alias("future")],
    f"row_seq, go_live_date > TIMESTAMP '{AS_OF}' AS future",
)
project(
    "b18_predicates", "orders",
    lambda: [
        *_c("row_seq"),
        F.col("industry").isNull().alias("no_industry"),
        F.col("order_amount").isNotNull().alias("has_amount"),
        F.col("nps_score").between(-50, 50).alias("neutral"),
        F.when(F.col("seats_used") < 0, "NEGATIVE").when(F.col("seats_used") > 400, "LARGE").otherwise("NORMAL").alias("band"),
    ],
    "row_seq, industry IS NULL AS no_industry, order_amount IS NOT NULL AS has_amount, nps_score BETWEEN -50 AND 50 AS neutral, "
    "CASE WHEN seats_used < 0 THEN 'NEGATIVE' WHEN seats_used > 400 THEN 'LARGE' ELSE 'NORMAL' END AS band",
)


@query(
    "b19_delete_where",
    ctes("dirty_orders") + "SELECT row_seq, order_amount FROM dirty_orders WHERE NOT coalesce(order_amount < 0, false)",
)
def _delete_where(spark, sf_dir):
    return delete_where(dirty(spark, sf_dir, "orders"), F.col("order_amount") < 0).select("row_seq", "order_amount")


project(
    "b20_select", "orders",
    lambda: [F.lit("RAW").alias("source"), F.col("row_seq").alias("id"), F.col("arr").alias("annual")],
    "'RAW' AS source, row_seq AS id, arr AS annual",
)


@query(
    "b21_replace_join",
    "SELECT a.p_partkey, replace(a.p_type, ' ', '_') AS type_key, n.parts FROM part a "
    "JOIN (SELECT replace(p_type, ' ', '_') AS type_key, count(*) AS parts FROM part GROUP BY 1) n "
    "ON replace(a.p_type, ' ', '_') = n.type_key",
)
def _replace_join(spark, sf_dir):
    from burnish.dirty import table
    from burnish.operators.skew import attach

    part = table(spark, sf_dir, "part").select(
        "p_partkey", X.replace_text(F.col("p_type"), " ", "_").alias("type_key")
    )
    parts = part.groupBy("type_key").agg(F.count(F.lit(1)).alias("parts"))
    return attach(part, parts, ["type_key"])


project(
    "b22_arithmetic", "workforce",
    lambda: [
        *_c("row_seq"),
        (F.col("pto_days_used") * F.col("pto_days_remaining")).alias("product"),
        (F.col("total_comp") - F.col("base_salary")).alias("difference"),
        (F.col("equity_grant") / 4).alias("quarter"),
        (F.col("base_salary") / 12 * 12).alias("year"),
        N.clean_ratio(F.col("pto_days_used"), F.col("pto_days_remaining")).alias("ratio"),
    ],
    "row_seq, pto_days_used * pto_days_remaining AS product, total_comp - base_salary AS difference, equity_grant / 4 AS quarter, "
    "base_salary / 12 * 12 AS year, CASE WHEN pto_days_remaining <> 0 THEN pto_days_used / pto_days_remaining END AS ratio",
)
project(
    "b23_first_last_word", "part",
    lambda: [*_c("p_partkey"), X.first_word(F.col("p_name")).alias("first_word"), X.last_word(F.col("p_name")).alias("last_word")],
    r"p_partkey, string_split_regex(trim(p_name), '\s+')[1] AS first_word, string_split_regex(trim(p_name), '\s+')[-1] AS last_word",
)
project(
    "b24_make_id", "customer",
    lambda: [*_c("c_custkey"), X.make_id("CUST-", F.col("c_custkey"), 9).alias("customer_code")],
    "c_custkey, concat('CUST-', lpad(CAST(c_custkey AS VARCHAR), 9, '0')) AS customer_code",
)
project(
    "b25_title_case", "part",
    lambda: [*_c("p_partkey"), X.title_case(F.col("p_name")).alias("title")],
    "p_partkey, array_to_string(list_transform(string_split(p_name, ' '), "
    "lambda x: concat(upper(substr(x, 1, 1)), lower(substr(x, 2)))), ' ') AS title",
)
project(
    "e16_trim_text", "workforce",
    lambda: [*_c("row_seq"), X.trim_ws(F.col("full_name")).alias("full_name")],
    "row_seq, trim(full_name) AS full_name",
)
project(
    "e17_clean_email", "workforce",
    lambda: [*_c("row_seq"), X.clean_email(F.col("email")).alias("email")],
    f"row_seq, {LOWERED_EMAIL} AS email",
)
project(
    "e47_standardise_rule", "orders",
    lambda: [*_c("row_seq"), X.standardise_rule(F.col("industry"), INDUSTRY).alias("industry")],
    "row_seq, CASE WHEN upper(trim(industry)) IN ('SAAS','SOFTWARE AS A SERVICE','S AS A SERVICE') THEN 'SAAS' "
    "ELSE upper(trim(industry)) END AS industry",
)
project(
    "e49_clean_version", "telemetry",
    lambda: [*_c("row_seq"), X.clean_version(F.col("firmware_version")).alias("firmware_version"),
             X.clean_version(F.col("firmware_version"), semver=True).alias("semver")],
    f"row_seq, {FIRMWARE} AS firmware_version, "
    f"CASE len(string_split({FIRMWARE}, '.')) WHEN 1 THEN concat({FIRMWARE}, '.0.0') WHEN 2 THEN concat({FIRMWARE}, '.0') ELSE {FIRMWARE} END AS semver",
)
project(
    "e50_clean_account_code", "ledger",
    lambda: [*_c("transaction_id", "l_partkey", "l_suppkey"), X.clean_account_code(F.col("account_code")).alias("account_code")],
    f"transaction_id, l_partkey, l_suppkey, {CODE} AS account_code",
)
project(
    "e51_strip_html", "catalog",
    lambda: [*_c("row_seq"), X.strip_html(F.col("description_en")).alias("description_en")],
    f"row_seq, {STRIPPED} AS description_en",
)
project(
    "e46_standardise", "catalog",
    lambda: [*_c("row_seq"), X.map_values(F.col("category_l1"), _category()).alias("category_l1")],
    f"row_seq, {CATEGORY} AS category_l1",
)
project(
    "e18_clean_phone", "customer",
    lambda: [
        *_c("c_custkey"),
        X.clean_phone(_phone()).alias("phone"),
    ],
    "c_custkey, CASE c_custkey % 4 WHEN 0 THEN concat('+1', lpad(CAST(c_custkey AS VARCHAR), 10, '2')) "
    "WHEN 1 THEN concat('+49', lpad(CAST(c_custkey AS VARCHAR), 8, '3')) "
    "WHEN 2 THEN concat('+33', lpad(CAST(c_custkey AS VARCHAR), 9, '4')) "
    "ELSE concat('ext ', CAST(c_custkey AS VARCHAR)) END AS phone",
)


def _category():
    from burnish.plans.domains import CATEGORY as mapping

    return mapping


def _phone():
    """Customer numbers written as phone texts of four styles."""
    key, digits = F.col("c_custkey") % 4, F.col("c_custkey").cast("string")
    ten = F.lpad(digits, 10, "2")
    return (
        F.when(key == 0, F.concat(F.lit("("), F.substring(ten, 1, 3), F.lit(") "), F.substring(ten, 4, 3), F.lit("-"), F.substring(ten, 7, 4)))
        .when(key == 1, F.concat(F.lit("+49 "), F.lpad(digits, 8, "3")))
        .when(key == 2, F.concat(F.lit("0033 "), F.lpad(digits, 9, "4")))
        .otherwise(F.concat(F.lit("ext "), digits))
    )
