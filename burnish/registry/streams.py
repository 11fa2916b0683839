"""Streaming queries (section K): each runs its stream over the whole table and reads the sink."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnish.dirty import VIEWS, table
from burnish.plans.rules import Check
from burnish.operators.profile import profile_columns
from burnish.registry.base import AS_OF_EVENTS, ctes, domain, query, raw
from burnish.registry.domains import as_text, cleaned_sql
from burnish.registry.profiles import sketched_sql
from burnish.registry.scores import DIMS
from burnish.session import shared_path
from burnish.streaming import incremental as K
from burnish.streaming import refresh, routing
from burnish.streaming.chunks import ChunkedClean


def stream(spark, sf_dir: str, name: str) -> DataFrame:
    return K.file_stream(spark, sf_dir, table(spark, sf_dir, name).schema, f"{name}.parquet")


def dirty_stream(spark, sf_dir: str, view: str, source: str) -> DataFrame:
    return spark.sql(VIEWS[view].replace(f"FROM {source}", f"FROM {{{source}}}"), **{source: stream(spark, sf_dir, source)})


@query(
    "k1_clean_stream",
    ctes("dirty_orders", "orders_stat")
    + "SELECT row_seq, abs(order_amount) AS order_amount, coalesce(nps_score, nps) AS nps_score, "
    "CASE WHEN order_amount IS NULL THEN 'NULL_MONETARY' WHEN order_amount < 0 THEN 'CONVERTED_NEGATIVE' END AS order_amount_flag "
    "FROM dirty_orders, orders_stat WHERE NOT coalesce(onboarding_date > go_live_date, false)",
)
def _clean_stream(spark, sf_dir):
    """Row-local stages on the stream with the statistics of the stored profile."""
    d = domain("orders")
    stats = d.clean(raw(spark, sf_dir, "orders")).stats
    path = shared_path(spark, "k1")
    cleaned = K.clean_stream(dirty_stream(spark, sf_dir, "orders", "orders"), K.row_local(d.rules), stats)
    K.run_available(cleaned, f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").select("row_seq", "order_amount", "nps_score", "order_amount_flag")


def in_order(df: DataFrame, folder: str, file_no: str, handler, checkpoint: str, n: int = 3, shape=lambda live: live) -> None:
    """Let ``df`` arrive in ``n`` parts, one after another, each a batch of ``handler``.

    A part is written by as many tasks as ``df`` has, and the stream takes up all its files at once
    before the next part is written.
    """
    for i in range(n):
        df.filter(F.expr(file_no) == i).write.mode("append").parquet(folder)
        K.run_batches(shape(K.file_stream(df.sparkSession, folder, df.schema, "*.parquet")), handler, checkpoint)


def settled(spark, sf_dir: str, name: str) -> DataFrame:
    """A domain's whole rule list over three parts, a batch each, settled at the end."""
    path, rows = shared_path(spark, "k1b"), raw(spark, sf_dir, name)
    last = rows.agg(F.max("row_seq")).first()[0]
    chunks = ChunkedClean.of(f"{path}/out", domain(name), rows.columns, settles=True)
    in_order(rows, f"{path}/in", f"row_seq * 3 div {last + 1}", chunks, f"{path}/checkpoint")
    return as_text(chunks.settle(spark, 3).frame, name)


@query("k1_clean_stream_batches", cleaned_sql("orders"))
def _clean_batches(spark, sf_dir):
    """Deletions, statistics and flags over three files equal one run over the table."""
    return settled(spark, sf_dir, "orders")


@query("k1_clean_stream_own_master", cleaned_sql("workforce"))
def _clean_own_master(spark, sf_dir):
    """The master of the foreign key is the table itself: known when the last file is in."""
    return settled(spark, sf_dir, "workforce")


@query(
    "k2_dedupe_stream",
    "SELECT DISTINCT user_id, event_type FROM events",
)
def _dedupe_stream(spark, sf_dir):
    """First event per (user, type) while copies arrive inside the watermark."""
    path = shared_path(spark, "k2")
    first = K.dedupe_stream(stream(spark, sf_dir, "events"), ["user_id", "event_type"], "ts", "60 days")
    K.run_available(first.select("user_id", "event_type"), f"{path}/out", f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out")


# NULL keys, and keys that come again in a later file.
_ARRIVING = (
    "SELECT CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE journal_entry_id % 500 END AS entry, l_partkey, l_suppkey, l_quantity, "
    "l_extendedprice, transaction_id, l_suppkey % 3 AS file_no FROM "
)
_ENTRY_ORDER = ["file_no", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "transaction_id"]


@query(
    "k2_dedupe_batches",
    ctes("dirty_ledger")
    + f"SELECT entry, file_no, l_partkey, l_suppkey, transaction_id FROM ({_ARRIVING} dirty_ledger) "
    f"QUALIFY row_number() OVER (PARTITION BY entry ORDER BY {', '.join(_ENTRY_ORDER)}) = 1",
)
def _dedupe_batches(spark, sf_dir):
    """Three files, a batch each, against the target table instead of state: no event time, no bound on delay."""
    path = shared_path(spark, "k2b")
    arriving = spark.sql(_ARRIVING + "{ledger}", ledger=raw(spark, sf_dir, "ledger"))
    handler = K.dedupe_into(f"{path}/out", ["entry"], _ENTRY_ORDER, compact_every=2)
    in_order(arriving, f"{path}/in", "file_no", handler, f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/out").select("entry", "file_no", "l_partkey", "l_suppkey", "transaction_id")


@query(
    "k3_route_late",
    f"SELECT event_id, CASE WHEN event_id % 70 = 1 THEN 'impossible' WHEN ts > TIMESTAMP '{AS_OF_EVENTS}' THEN 'clock_drift' ELSE 'ok' END AS route FROM events",
)
def _route(spark, sf_dir):
    path = shared_path(spark, "k3")
    arrived = stream(spark, sf_dir, "events").withColumn(
        "ingested", F.expr("CASE WHEN event_id % 70 = 1 THEN ts - INTERVAL 1 HOUR ELSE ts + INTERVAL 30 SECOND END")
    )
    routed = K.route_late(arrived, "ts", "ingested", AS_OF_EVENTS).select("event_id", "route")
    K.run_available(routed, f"{path}/out", f"{path}/checkpoint", ["route"])
    return spark.read.parquet(f"{path}/out").select("event_id", "route")


# Ten days a file; every twentieth event comes a file late.
_DELAYED = (
    "SELECT event_id, ts, CASE WHEN event_id % 70 = 1 THEN ts - INTERVAL 1 HOUR ELSE ts + INTERVAL 30 SECOND END AS ingested, "
    "least(2, CASE WHEN day(ts) <= 10 THEN 0 WHEN day(ts) <= 20 THEN 1 ELSE 2 END + CASE WHEN event_id % 20 = 0 THEN 1 ELSE 0 END) AS file_no FROM "
)


@query(
    "k3_route_late_quarantine",
    f"""
WITH arrived AS ({_DELAYED} events),
judged AS (SELECT *, CASE WHEN ingested < ts THEN 'impossible' WHEN ts > TIMESTAMP '{AS_OF_EVENTS}' THEN 'clock_drift' END AS wrong FROM arrived),
marks AS (SELECT n, (SELECT max(ts) FROM judged WHERE file_no < n AND wrong IS NULL) - INTERVAL 1 DAY AS watermark FROM (SELECT unnest([0, 1, 2]) AS n)),
routed AS (
  SELECT event_id, file_no, watermark, coalesce(wrong, CASE WHEN ts < watermark THEN 'late' ELSE 'ok' END) AS route
  FROM judged JOIN marks ON n = file_no)
SELECT event_id, file_no, route, CASE WHEN route = 'ok' THEN 'ok' ELSE 'quarantine' END AS sink,
       strftime(watermark, '%Y-%m-%d %H:%M:%S') AS watermark FROM routed""",
)
def _quarantine(spark, sf_dir):
    """Three files with late, impossible and drifting rows, each row in exactly one sink."""
    path = shared_path(spark, "k3b")
    arrived = spark.sql(_DELAYED + "{events}", events=table(spark, sf_dir, "events"))
    in_order(arrived, f"{path}/in", "file_no", routing.route_to_sinks(f"{path}/out", "ts", "ingested", "1 DAY", AS_OF_EVENTS), f"{path}/checkpoint")
    both = [routing.sink(spark, f"{path}/out", s).withColumn("sink", F.lit(s)) for s in routing.SINKS]
    rows = both[0].unionByName(both[1])
    return rows.select("event_id", "file_no", "route", "sink", F.date_format("watermark", "yyyy-MM-dd HH:mm:ss").alias("watermark"))


EVENT_CHECKS = [
    Check("low_value", "validity", "WARNING", "value", "value < 5"),
    Check("unknown_type", "consistency", "WARNING", "event_type", "event_type NOT IN ('view', 'click', 'purchase')"),
    Check("odd_second", "accuracy", "INFO", "ts", "second(ts) >= 58"),
]


@query(
    "k4_windowed_quality",
    "SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS window_start, count(*) AS total_rows, "
    "count(*) FILTER (NOT coalesce(value < 5, false)) AS validity_rows, "
    "count(*) FILTER (event_type IN ('view', 'click', 'purchase')) AS consistency_rows, "
    "count(*) FILTER (NOT second(ts) >= 58) AS accuracy_rows FROM events GROUP BY 1",
)
def _windows(spark, sf_dir):
    found = K.windowed_quality(table(spark, sf_dir, "events"), "ts", "1 hour", EVENT_CHECKS)
    return found.select(
        F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"),
        "total_rows", "validity_rows", "consistency_rows", "accuracy_rows",
    )


@query(
    "k5_on_refresh",
    ctes("scores_catalog")
    + "SELECT total_rows, round(completeness, 6) AS completeness, round(validity, 6) AS validity, round(uniqueness, 6) AS uniqueness, "
    "round(consistency, 6) AS consistency, round(accuracy, 6) AS accuracy, overall, grade FROM scores_catalog WHERE layer = 'raw'",
)
def _refresh(spark, sf_dir):
    """Each refresh of the catalog is profiled and scored as it lands."""
    path = shared_path(spark, "k5")
    handler = K.on_refresh(domain("catalog"), path)
    K.run_batches(dirty_stream(spark, sf_dir, "catalog", "part"), handler, f"{path}/checkpoint")
    return spark.read.parquet(f"{path}/score").select(
        "total_rows", *[F.round(d, 6).alias(d) for d in DIMS], "overall", "grade"
    )


@query("k5_profile_merged", ctes("dirty_orders") + sketched_sql("orders"))
def _profile_merged(spark, sf_dir):
    """Three refreshes, each sketched as it lands: the merged profile is that of the whole table."""
    path, rows = shared_path(spark, "k5b"), raw(spark, sf_dir, "orders")
    in_order(rows, f"{path}/in", "row_seq % 3", refresh.sketch_batches(f"{path}/out"), f"{path}/checkpoint", shape=lambda live: refresh.observed(live, rows.columns))
    exact = profile_columns(rows).select("column_name", F.col("distinct_count").alias("exact"))
    done = refresh.merged_profile(spark, f"{path}/out", 2).join(exact, "column_name")
    close = F.abs(F.col("distinct_count") - F.col("exact")) <= F.col("exact") * 0.05
    return done.select("column_name", "data_type", "total_rows", "null_count", "null_pct", "min_value", "max_value", "text_chars", close.alias("distinct_close"))
