"""Five views with injected defects over the clean test tables.

The text runs unchanged in Spark and DuckDB (a hint is a comment to the latter).
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "orders": """
SELECT o_orderkey AS row_seq,
  concat('ORD-', lpad(CAST(CASE WHEN o_orderkey % 333 = 332 THEN o_orderkey - 332 ELSE o_orderkey END AS STRING), 7, '0')) AS order_id,
  CASE WHEN o_orderkey % 200 = 7 THEN o_custkey + 1000000000 ELSE o_custkey END AS customer_id,
  o_orderdate AS order_date,
  CASE WHEN o_orderkey % 67 = 3 THEN NULL WHEN o_orderkey % 997 = 5 THEN -o_totalprice ELSE o_totalprice END AS order_amount,
  CASE WHEN o_orderkey % 22 = 0 THEN o_totalprice * 1e1 ELSE o_totalprice END AS total_amount,
  CASE o_orderkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'Active' ELSE 'actv' END AS status,
  CASE o_orderkey % 6 WHEN 0 THEN 'SaaS' WHEN 1 THEN 'SAAS' WHEN 2 THEN 'Software as a Service' WHEN 3 THEN ' FinTech ' WHEN 4 THEN NULL ELSE 'Retail' END AS industry,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 83 = 1 THEN concat('  Name ', CAST(o_custkey AS STRING), '  ') ELSE concat('Name ', CAST(o_custkey AS STRING)) END AS customer_name,
  CASE o_orderkey % 61 WHEN 0 THEN 'userATdomain.com1' WHEN 1 THEN 'user@domaincom2' WHEN 2 THEN 'user@.com3' WHEN 3 THEN 'user@domain.4' WHEN 4 THEN '@domain.com5' WHEN 5 THEN 'nodomain6' ELSE concat('User', CAST(o_custkey AS STRING), '@Mail.example.com') END AS email,
  CASE WHEN o_orderkey % 20 < 3 THEN NULL ELSE CAST((o_orderkey * 7919) % 201 - 100 AS DOUBLE) END AS nps_score,
  CASE WHEN o_orderkey % 25 < 2 THEN NULL ELSE CAST((o_orderkey * 104729) % 101 AS DOUBLE) END AS health_score,
  CASE WHEN o_orderkey % 50 = 11 THEN -CAST(o_orderkey % 49 + 1 AS DOUBLE) ELSE CAST(o_orderkey % 500 AS DOUBLE) END AS seats_used,
  o_totalprice AS arr,
  CASE WHEN o_orderkey % 500 = 9 THEN o_totalprice / 8e0 ELSE o_totalprice / 12e0 END AS mrr,
  o_orderdate AS onboarding_date,
  CASE WHEN o_orderkey % 444 = 2 THEN o_orderdate - INTERVAL 9 DAY ELSE o_orderdate + INTERVAL 30 DAY END AS go_live_date
FROM orders
""",
    "telemetry": """
SELECT /*+ BROADCAST(firsts) */ event_id AS row_seq,
  concat('DEV-', lpad(CAST(user_id % 50 + 1 AS STRING), 4, '0')) AS device_id,
  CASE WHEN event_id % 50 = 49 THEN first_ts ELSE ts END AS reading_timestamp,
  CASE WHEN event_id % 70 = 1 THEN ts - INTERVAL 1 HOUR ELSE ts + INTERVAL 30 SECOND END AS ingestion_timestamp,
  CASE WHEN event_id % 125 = 0 THEN 501e0 + value WHEN event_id % 125 = 62 THEN -51e0 - value ELSE 20e0 + value / 4e0 END AS temperature_c,
  CAST((event_id * 31) % 110 AS DOUBLE) AS humidity_pct,
  CASE WHEN event_id % 83 = 4 THEN -1e0 - value ELSE 10e0 + value END AS pressure_psi,
  CASE event_type WHEN 'view' THEN 'idle' WHEN 'error' THEN 'fault' WHEN 'signup' THEN 'maintenance' ELSE 'running' END AS device_status,
  CASE WHEN event_id % 100 = 8 THEN 0e0 ELSE 5e-1 + value END AS vibration_hz,
  CAST(200 + event_id % 281 AS DOUBLE) AS voltage_v,
  CAST(1 + event_id % 100 AS DOUBLE) AS current_a,
  CASE WHEN event_id % 333 = 6 THEN 15e-1 ELSE 1e0 END * CAST((200 + event_id % 281) * (1 + event_id % 100) AS DOUBLE) / 1e3 AS power_kw,
  CASE WHEN event_id % 200 = 12 THEN 1124e-1 ELSE CAST(60 + event_id % 38 AS DOUBLE) END AS efficiency_pct,
  CASE WHEN event_id % 20 = 13 THEN NULL ELSE CAST(1 + (event_id * 17) % 365 AS DOUBLE) END AS predicted_failure_days,
  CASE WHEN event_id % 33 = 14 THEN NULL ELSE value END AS torque_nm,
  CASE event_id % 7 WHEN 0 THEN 'v2.1' WHEN 1 THEN '2.1.0' WHEN 2 THEN '2_1' WHEN 3 THEN 'Version 2.1' WHEN 4 THEN 'v3.0' WHEN 5 THEN '3.0.0' ELSE '3_0' END AS firmware_version,
  CASE event_id % 4 WHEN 0 THEN 'PUMP' WHEN 1 THEN 'Pump' WHEN 2 THEN 'pump' ELSE 'PUMP_V2' END AS device_type
FROM events JOIN (SELECT user_id % 50 AS slot, min(ts) AS first_ts FROM events GROUP BY user_id % 50) firsts ON user_id % 50 = slot
""",
    "workforce": """
SELECT c_custkey AS row_seq,
  CASE WHEN c_custkey % 100 = 99 THEN c_custkey - 99 ELSE c_custkey END AS employee_id,
  CASE WHEN c_custkey % 50 = 17 THEN c_custkey + 1000000000 WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey - c_custkey % 10 END AS manager_id,
  CASE WHEN c_custkey % 20 = 4 THEN NULL WHEN c_custkey % 60 = 7 THEN concat('  ', c_name, '  ') ELSE c_name END AS full_name,
  CASE c_custkey % 67 WHEN 0 THEN 'userATdomain.com1' WHEN 1 THEN 'user@domaincom2' WHEN 2 THEN 'user@.com3' WHEN 3 THEN '@domain.com4' ELSE concat(c_name, '@Corp.example.com') END AS email,
  CASE WHEN c_custkey % 97 = 5 THEN last_dt ELSE first_dt END AS hire_date,
  CASE WHEN c_custkey % 4 <> 1 AND c_custkey % 97 <> 5 THEN NULL WHEN c_custkey % 97 = 5 THEN first_dt ELSE last_dt END AS termination_date,
  CASE c_custkey % 8 WHEN 0 THEN 'Eng' WHEN 1 THEN 'Engineering' WHEN 2 THEN 'ENGINEERING' WHEN 3 THEN 'R&D' WHEN 4 THEN 'Customer Success' WHEN 5 THEN 'Sales' WHEN 6 THEN 'HR' ELSE 'Ops' END AS department,
  CASE c_custkey % 5 WHEN 0 THEN 'active' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'Active' WHEN 3 THEN 'terminated' ELSE 'Terminated' END AS employment_status,
  CASE WHEN c_custkey % 50 = 21 THEN -(80000e0 + c_acctbal) ELSE 80000e0 + c_acctbal END AS base_salary,
  CASE WHEN c_custkey % 20 IN (3, 8, 13) THEN NULL ELSE CAST(5000 + c_custkey % 4500 AS DOUBLE) END AS bonus_target,
  CASE WHEN c_custkey % 25 IN (6, 19) THEN NULL ELSE CAST((c_custkey * 37) % 20000 AS DOUBLE) END AS equity_grant,
  CASE WHEN c_custkey % 33 = 9 THEN 70000e0 ELSE 200000e0 + c_acctbal END AS total_comp,
  90000e0 - CAST(c_custkey % 40 AS DOUBLE) * 1e2 AS salary_band_max,
  CASE WHEN c_custkey % 300 = 10 THEN 8e0 WHEN c_custkey % 300 = 160 THEN -1e0 ELSE CAST(1 + c_custkey % 5 AS DOUBLE) END AS perf_rating_2024,
  CAST(c_custkey % 25 AS DOUBLE) AS pto_days_used,
  CASE WHEN c_custkey % 150 = 30 THEN -5e0 ELSE CAST(c_custkey % 30 AS DOUBLE) END AS pto_days_remaining
FROM customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_dt, max(o_orderdate) AS last_dt FROM orders GROUP BY o_custkey) f ON c_custkey = o_custkey
""",
    "ledger": """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS transaction_id,
  l_orderkey AS journal_entry_id, l_partkey, l_suppkey, l_quantity, l_extendedprice,
  l_shipdate AS posting_date,
  CASE WHEN l_partkey % 211 = 1 THEN l_shipdate - INTERVAL 400 DAY ELSE l_shipdate - INTERVAL 5 DAY END AS effective_date,
  CASE WHEN l_partkey % 307 = 2 THEN l_shipdate - INTERVAL 3 DAY ELSE l_shipdate + INTERVAL 2 DAY END AS approval_date,
  CASE WHEN l_partkey % 401 = 3 THEN -l_extendedprice WHEN l_partkey % 50 = 4 THEN l_extendedprice + 1e-7 ELSE l_extendedprice END AS debit_amount,
  CASE WHEN l_partkey % 131 = 5 THEN l_extendedprice * 9e-1 ELSE l_extendedprice END AS credit_amount,
  CASE WHEN l_partkey % 100 = 6 THEN 12345e-2 WHEN l_partkey % 401 = 3 THEN -2e0 * l_extendedprice WHEN l_partkey % 131 = 5 THEN l_extendedprice * 1e-1 ELSE 0e0 END AS net_amount,
  CASE l_suppkey % 7 WHEN 1 THEN 'EUR' WHEN 2 THEN 'GBP' WHEN 3 THEN 'JPY' ELSE 'USD' END AS currency,
  CASE WHEN l_suppkey % 7 NOT IN (1, 2, 3) THEN 1e0 WHEN l_partkey % 50 = 7 THEN NULL ELSE CAST(l_suppkey % 7 AS DOUBLE) + l_discount END AS fx_rate,
  CASE l_partkey % 10 WHEN 6 THEN concat(CAST(1000 + l_suppkey * 10 AS STRING), '-00') WHEN 7 THEN concat('GL-', CAST(1000 + l_suppkey * 10 AS STRING)) WHEN 8 THEN concat('0', CAST(1000 + l_suppkey * 10 AS STRING)) ELSE CAST(1000 + l_suppkey * 10 AS STRING) END AS account_code,
  CASE l_partkey % 7 WHEN 0 THEN 'approved' WHEN 1 THEN 'APPROVED' WHEN 2 THEN 'Approved' WHEN 3 THEN 'apprvd' WHEN 4 THEN 'pending' WHEN 5 THEN 'PENDING' ELSE 'rejected' END AS approval_status,
  CASE WHEN l_partkey % 100 = 8 THEN l_suppkey + 1000000000 ELSE l_suppkey END AS vendor_id,
  CASE WHEN l_orderkey % 7 = 0 THEN 1 ELSE 0 END AS intercompany_flag
FROM lineitem
""",
    "catalog": """
SELECT p_partkey AS row_seq,
  concat('PROD-', lpad(CAST(CASE WHEN p_partkey % 50 = 49 THEN p_partkey - 49 ELSE p_partkey END AS STRING), 9, '0')) AS product_id,
  CASE WHEN p_partkey % 33 = 1 THEN NULL WHEN p_partkey % 125 = 2 THEN -p_retailprice ELSE p_retailprice END AS price_usd,
  CASE WHEN p_partkey % 33 = 5 THEN p_retailprice * 92e-2 * 85e-2 ELSE p_retailprice * 92e-2 END AS price_eur,
  CASE WHEN p_partkey % 200 = 3 THEN 150e0 WHEN p_partkey % 200 = 103 THEN -75e0 ELSE CAST(p_size AS DOUBLE) END AS margin_pct,
  CASE WHEN p_partkey % 300 = 6 THEN -5e0 ELSE CAST(p_partkey % 1000 AS DOUBLE) END AS stock_quantity,
  CAST(p_size AS DOUBLE) AS weight_kg,
  CAST(p_size AS DOUBLE) * CASE WHEN p_partkey % 12 = 7 THEN 19e-1 ELSE 2205e-3 END AS weight_lbs,
  CASE p_partkey % 6 WHEN 0 THEN 'Electronics' WHEN 1 THEN 'ELECTRONICS' WHEN 2 THEN 'Elec.' WHEN 3 THEN 'electronic' WHEN 4 THEN 'Clothing' ELSE 'Garden' END AS category_l1,
  CASE WHEN p_partkey % 40 = 8 THEN concat('<p><b>Great product!</b> ', p_name, '</p><br/>') ELSE p_name END AS description_en,
  CASE WHEN p_partkey % 20 = 9 THEN NULL ELSE concat('hi ', p_name) END AS product_name_hi,
  CASE WHEN p_partkey % 12 = 10 THEN NULL ELSE concat('ja ', p_name) END AS product_name_ja,
  DATE '2020-01-01' + CAST(p_partkey % 1461 AS INT) AS created_at,
  DATE '2020-01-01' + CAST(p_partkey % 1461 + CASE WHEN p_partkey % 500 = 11 THEN -7 ELSE 20 END AS INT) AS published_at
FROM part
""",
}

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the dirty views over the tables in ``sf_dir``."""
    text = VIEWS[name]
    used = [t for t in TABLES if re.search(rf"\b(FROM|JOIN) {t}\b", text)]
    for t in used:
        text = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{{t}}}", text)
    return spark.sql(text, **{t: table(spark, sf_dir, t) for t in used})
