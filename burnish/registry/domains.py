"""The five domain rule sets end to end."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnish.dirty import table
from burnish.registry.base import TEXTS, cleaned, ctes, domain, query, raw, stamp

STAMPS = {
    "orders": ("order_date", "onboarding_date", "go_live_date"),
    "telemetry": ("reading_timestamp", "ingestion_timestamp"),
    "workforce": ("hire_date", "termination_date"),
    "ledger": ("posting_date", "effective_date", "approval_date"),
    "catalog": ("created_at", "published_at"),
}
IDS = {
    "n1_clean_orders": "orders",
    "n2_clean_telemetry": "telemetry",
    "n3_clean_workforce": "workforce",
    "n4_clean_ledger": "ledger",
    "n5_clean_catalog": "catalog",
}


# Integers that may be NULL travel as text: clients differ in how they hold them.
NULLABLE_IDS = {"workforce": ("manager_id",)}


def as_text(df, name: str):
    ids = NULLABLE_IDS.get(name, ())
    return df.select(
        *[
            stamp(c) if c in STAMPS[name] else F.col(c).cast("string").alias(c) if c in ids else F.col(c)
            for c in df.columns
        ]
    )


def cleaned_sql(name: str) -> str:
    parts = [f"strftime({c}, '%Y-%m-%d %H:%M:%S') AS {c}" for c in STAMPS[name]]
    parts += [f"CAST({c} AS VARCHAR) AS {c}" for c in NULLABLE_IDS.get(name, ())]
    replaced = ", ".join(parts)
    return ctes(f"clean_{name}") + f"SELECT * REPLACE ({replaced}) FROM clean_{name}"


for _id, _name in IDS.items():
    assert f"clean_{_name}" in TEXTS
    query(_id, cleaned_sql(_name))(lambda spark, sf_dir, name=_name: as_text(cleaned(spark, sf_dir, name), name))


@query(
    "n1_clean_orders_by_master",
    cleaned_sql("orders").replace("SELECT * REPLACE (", "SELECT * REPLACE (CASE WHEN customer_id NOT IN (SELECT c_custkey FROM customer) THEN 'ORPHANED_FK' END AS customer_id_flag, "),
)
def _orders_by_master(spark, sf_dir):
    """The customer master decides which customers are unknown, instead of a pattern."""
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    done = domain("orders", customers="c_custkey").clean(raw(spark, sf_dir, "orders"), {"customers": customers})
    return as_text(done.frame, "orders")
