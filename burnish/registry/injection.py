"""Injection queries (section L) over the clean tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnish.dirty import table
from burnish.operators import inject as I
from burnish.registry.base import query


def inject(name: str, source: str, fn, show: list[str], sql: str) -> None:
    def run(spark, sf_dir):
        return fn(table(spark, sf_dir, source)).select(*show)

    query(name, f"SELECT {sql} FROM {source}")(run)


inject(
    "l1_inject_nulls", "customer", lambda df: I.inject_nulls(df, "c_acctbal", "c_custkey", 5),
    ["c_custkey", "c_acctbal"], "c_custkey, CASE WHEN c_custkey % 20 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal",
)
inject(
    "l2_inject_negatives", "orders", lambda df: I.inject_negatives(df, "o_totalprice", "o_orderkey", 2, offset=1),
    ["o_orderkey", "o_totalprice"],
    "o_orderkey, CASE WHEN o_orderkey % 50 = 1 THEN -abs(o_totalprice) ELSE o_totalprice END AS o_totalprice",
)
def _dup_sql(key: str, pct: int) -> str:
    """Within a block of about 1000 rows, every so many take the key of the last row that keeps its own."""
    return (
        "o_orderkey, coalesce(last_value(CASE WHEN NOT taken THEN k END IGNORE NULLS) OVER (PARTITION BY b ORDER BY o_orderkey "
        "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), k) AS order_id FROM "
        f"(SELECT o_orderkey, b, {key} AS k, (r + 1) * {pct} // 100 > r * {pct} // 100 AS taken FROM "
        "(SELECT o_orderkey, b, row_number() OVER (PARTITION BY b ORDER BY o_orderkey) - 1 AS r FROM (SELECT o_orderkey, (o_orderkey - lo) // w AS b "
        "FROM orders, (SELECT min(o_orderkey) AS lo, greatest(1, 1000 * (max(o_orderkey) - min(o_orderkey) + 1) // count(*)) AS w FROM orders))))"
    )


def _dup(name: str, key: str, pct: int) -> None:
    def run(spark, sf_dir):
        df = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(key).alias("order_id"))
        return I.inject_dup_keys(df, "order_id", "o_orderkey", pct)

    query(name, f"SELECT {_dup_sql(key, pct)}")(run)


_dup("l3_inject_dup_keys", "o_orderkey", 1)
_dup("l3_inject_dup_keys_8pct", "o_orderkey", 8)
_dup("l3_inject_dup_keys_40pct_sparse", "o_orderkey * 7919", 40)


_OUTLYING = "CASE WHEN o_orderkey = (SELECT max(o_orderkey) FROM {orders}) THEN 1000000000000000 ELSE o_orderkey END"


@query(
    "l3_inject_dup_keys_outlier",
    f"WITH t AS (SELECT {_OUTLYING.format(orders='orders')} AS k FROM orders), "
    "a AS (SELECT k, (k - lo) // w AS b FROM t, (SELECT min(k) AS lo, greatest(1, 1000 * (max(k) - min(k) + 1) // count(*)) AS w FROM t)), "
    "c AS (SELECT k, b, CASE WHEN n > 2000 THEN (k - lo) // least(greatest(1, 1000 * (hi - lo + 1) // n), (hi - lo + 2) // 2) END AS b2 "
    "FROM a JOIN (SELECT b, count(*) AS n, min(k) AS lo, max(k) AS hi FROM a GROUP BY b) USING (b)), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY b, b2 ORDER BY k) - 1 AS r FROM c), "
    "s AS (SELECT *, (r + 1) * 5 // 100 > r * 5 // 100 AS taken FROM r) "
    "SELECT k AS o_orderkey, coalesce(last_value(CASE WHEN NOT taken THEN k END IGNORE NULLS) OVER (PARTITION BY b, b2 ORDER BY k "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), k) AS order_id FROM s",
)
def _dup_outlier(spark, sf_dir):
    """One key far beyond the others: their block is cut again."""
    keys = spark.sql(f"SELECT {_OUTLYING} AS o_orderkey FROM {{orders}}", orders=table(spark, sf_dir, "orders"))
    return I.inject_dup_keys(keys.withColumn("order_id", F.col("o_orderkey")), "order_id", "o_orderkey", 5)


def _rate(name: str, source: str, key: str, column: str, pct: int, fn, sql: str) -> None:
    """A rate that divides no hundred: still exact within one key per run of keys."""
    shown = f"{key}, CASE WHEN ({key} * {pct * 10_000}) % 1000000 < {pct * 10_000} THEN {sql} ELSE {column} END AS {column}"
    inject(name, source, lambda df: fn(df, column, key, pct), [key, column], shown)


for _pct in (8, 40):
    _rate(f"l1_inject_nulls_{_pct}pct", "customer", "c_custkey", "c_acctbal", _pct, I.inject_nulls, "NULL")
    _rate(f"l2_inject_negatives_{_pct}pct", "orders", "o_orderkey", "o_totalprice", _pct, I.inject_negatives, "-abs(o_totalprice)")
    _rate(f"l9_inject_orphans_{_pct}pct", "orders", "o_orderkey", "o_custkey", _pct, I.inject_orphans, "o_custkey + 1000000000")
    _rate(
        f"l13_inject_outliers_{_pct}pct", "orders", "o_orderkey", "o_totalprice", _pct,
        lambda df, c, k, p: I.inject_outliers(df, c, k, 10.0, p), "o_totalprice * 1e1",
    )


inject(
    "l4_inject_range", "events", lambda df: I.inject_range(df, "value", "event_id", [900.0, -90.0], 1),
    ["event_id", "value"],
    "event_id, CASE WHEN event_id % 200 = 0 THEN 900 WHEN event_id % 200 = 100 THEN -90 ELSE value END AS value",
)
inject(
    "l5_inject_reversed", "lineitem",
    lambda df: I.inject_reversed(
        df.withColumn("received", F.col("l_shipdate") + F.expr("INTERVAL 5 DAY")), "l_shipdate", "received", "l_partkey", 2
    ).withColumn("days", F.timestamp_diff("DAY", F.col("l_shipdate"), F.col("received"))),
    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "days"],
    "l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CASE WHEN l_partkey % 50 = 0 THEN -7 ELSE 5 END AS BIGINT) AS days",
)
inject(
    "l6_inject_dates", "orders",
    lambda df: I.inject_dates(
        I.inject_dates(df, "o_orderdate", "o_orderkey", "2030-01-01 00:00:00", 1), "o_orderdate", "o_custkey",
        "1980-06-01 00:00:00", 1,
    ).withColumn("order_year", F.year("o_orderdate").cast("bigint")),
    ["o_orderkey", "order_year"],
    "o_orderkey, CASE WHEN o_custkey % 100 = 0 THEN 1980 WHEN o_orderkey % 100 = 0 THEN 2030 ELSE year(o_orderdate) END AS order_year",
)
inject(
    "l7_inject_variants", "orders",
    lambda df: I.inject_variants(df, "o_orderstatus", "o_orderkey", ["active", "ACTIVE", "Active", "actv"]),
    ["o_orderkey", "o_orderstatus"],
    "o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'ACTIVE' WHEN 2 THEN 'Active' ELSE 'actv' END AS o_orderstatus",
)
inject(
    "l8_inject_bad_text", "customer",
    lambda df: I.inject_padding(
        I.inject_bad_text(
            df.withColumn("email", F.concat("c_name", F.lit("@mail.example.com"))), "email", "c_custkey",
            ["userATdomain.com{n}", "user@domaincom{n}", "@domain.com{n}"], 30,
        ),
        "c_name", "c_custkey", 25,
    ),
    ["c_custkey", "c_name", "email"],
    "c_custkey, CASE WHEN c_custkey % 25 = 0 THEN concat('  ', c_name, '  ') ELSE c_name END AS c_name, "
    "CASE c_custkey % 30 WHEN 0 THEN concat('userATdomain.com', c_custkey) WHEN 1 THEN concat('user@domaincom', c_custkey) "
    "WHEN 2 THEN concat('@domain.com', c_custkey) ELSE concat(c_name, '@mail.example.com') END AS email",
)
inject(
    "l9_inject_orphans", "orders", lambda df: I.inject_orphans(df, "o_custkey", "o_orderkey", 0.5),
    ["o_orderkey", "o_custkey"],
    "o_orderkey, CASE WHEN o_orderkey % 200 = 0 THEN o_custkey + 1000000000 ELSE o_custkey END AS o_custkey",
)
inject(
    "l10_inject_identity", "part", lambda df: I.inject_identity(df, "p_retailprice", "p_partkey", 0.8, 10),
    ["p_partkey", "p_retailprice"],
    "p_partkey, CASE WHEN p_partkey % 10 = 0 THEN p_retailprice * 8e-1 ELSE p_retailprice END AS p_retailprice",
)
inject(
    "l11_inject_imbalance", "lineitem",
    lambda df: I.inject_imbalance(df, "l_extendedprice", "l_orderkey", "l_partkey", 2),
    ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"],
    "l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_orderkey % 50 = 0 AND l_partkey % 2 = 0 THEN l_extendedprice * 11e-1 ELSE l_extendedprice END AS l_extendedprice",
)
inject(
    "l12_inject_text_noise", "part",
    lambda df: I.inject_text_noise(
        I.inject_text_noise(
            I.inject_text_noise(
                I.inject_text_noise(df, "p_name", "p_partkey", "html", 40), "p_type", "p_partkey", "encoding", 30
            ),
            "p_brand", "p_partkey", "swap", 25, other="p_type",
        ),
        "p_retailprice", "p_partkey", "float", 20,
    ),
    ["p_partkey", "p_name", "p_type", "p_brand", "p_retailprice"],
    "p_partkey, CASE WHEN p_partkey % 40 = 0 THEN concat('<p><b>', p_name, '</b></p><br/>') ELSE p_name END AS p_name, "
    "CASE WHEN p_partkey % 30 = 0 THEN concat(p_type, chr(65533)) ELSE p_type END AS p_type, "
    "CASE WHEN p_partkey % 25 = 0 THEN CASE WHEN p_partkey % 30 = 0 THEN concat(p_type, chr(65533)) ELSE p_type END ELSE p_brand END AS p_brand, "
    "CASE WHEN p_partkey % 20 = 0 THEN p_retailprice + 1e-7 ELSE p_retailprice END AS p_retailprice",
)
inject(
    "l13_inject_outliers", "orders", lambda df: I.inject_outliers(df, "o_totalprice", "o_orderkey", 10.0, 4),
    ["o_orderkey", "o_totalprice"],
    "o_orderkey, CASE WHEN o_orderkey % 25 = 0 THEN o_totalprice * 1e1 ELSE o_totalprice END AS o_totalprice",
)
