"""Cleaning, routing and profiling over several batches against one pass over everything."""

import math

import pytest
from pyspark.sql import functions as F

from burnish.operators import counted, sketches
from burnish.plans.domains import DOMAINS
from burnish.plans.engine import clean, compute_stats
from burnish.plans.rules import Stat
from burnish.streaming import incremental as K
from burnish.streaming import refresh, routing
from burnish.streaming.chunks import ChunkedClean

EVENTS = "id int, at string, read string"


def _events(spark, rows):
    df = spark.createDataFrame(rows, EVENTS)
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("at", "read")})


BATCHES = [
    [(1, "2024-01-01 10:00:00", "2024-01-01 10:00:05"), (2, "2024-01-03 00:00:00", "2024-01-03 00:00:01"), (3, None, None), (4, "2030-01-01 00:00:00", "2030-01-02 00:00:00")],
    [(5, "2024-01-01 23:59:59", "2024-01-05 00:00:00"), (6, "2024-01-02 00:00:00", "2024-01-05 00:00:00"), (7, "2024-01-06 00:00:00", "2024-01-05 00:00:00")],
    [(8, "2024-01-01 00:00:00", "2024-01-09 00:00:00"), (9, "2024-01-04 00:00:00", None)],
]


def test_rows_later_than_the_watermark_are_quarantined(spark, tmp_path):
    path = str(tmp_path)
    handler = routing.route_to_sinks(path, "at", "read", "1 DAY", "2025-01-01")
    for _ in range(2):  # the whole run again: every batch overwrites its own folders
        for n, rows in enumerate(BATCHES):
            handler(_events(spark, rows), n)
            handler(_events(spark, rows), n)
    kept = {r.id for r in routing.sink(spark, path, "ok").collect()}
    out = {r.id: (r.route, str(r.watermark)) for r in routing.sink(spark, path, "quarantine").collect()}
    # 4 is from the future and 7 was read before it happened: neither moves the watermark.
    assert kept == {1, 2, 6, 9}
    late = "2024-01-02 00:00:00"
    assert out == {3: ("no_time", "None"), 4: ("clock_drift", "None"), 5: ("late", late), 7: ("impossible", late), 8: ("late", late)}
    counts = {r.batch_id: (r.rows, r.ok, r.late, r.impossible, r.clock_drift, r.no_time) for r in routing.all_progress(spark, path, 3).collect()}
    assert counts == {0: (4, 2, 0, 0, 1, 1), 1: (3, 1, 1, 1, 0, 0), 2: (2, 1, 1, 0, 0, 0)}
    assert kept.isdisjoint(out) and len(kept) + len(out) == sum(map(len, BATCHES))


def test_routing_without_an_ingest_time_and_empty_batches(spark, tmp_path):
    path = str(tmp_path)
    handler = routing.route_to_sinks(path, "at", None, "2 HOURS", "2025-01-01")
    handler(_events(spark, []), 0)
    handler(_events(spark, BATCHES[0]), 1)
    handler(_events(spark, []), 2)
    handler(_events(spark, [(9, "2024-01-02 21:59:59", None), (10, "2024-01-02 22:00:00", None)]), 3)
    assert {r.id for r in routing.sink(spark, path, "ok").collect()} == {1, 2, 10}
    assert routing.progress(spark, path, 2).first()["watermark"] == routing.progress(spark, path, 3).first()["watermark"]


def _batches(rows, n):
    last = rows.agg(F.max("row_seq")).first()[0] + 1
    return [rows.filter(F.expr(f"row_seq * {n} div {last}") == i) for i in range(n)]


@pytest.mark.parametrize("name", ["orders", "telemetry", "workforce"])
def test_three_batches_equal_one_run_rule_by_rule(spark, small, tmp_path, name):
    from burnish.dirty import dirty
    from burnish.registry.base import domain

    rows, rules = dirty(spark, small, name), domain(name)
    chunks = ChunkedClean.of(str(tmp_path), rules, rows.columns, settles=True)
    for n, batch in enumerate(_batches(rows, 3)):
        chunks(batch, n)
        if n == 1:
            chunks(batch, n)  # a repeated batch changes nothing
    whole, done = rules.clean(rows), chunks.settle(spark, 3)
    assert done.frame.columns == whole.frame.columns
    assert done.frame.exceptAll(whole.frame).isEmpty() and whole.frame.exceptAll(done.frame).isEmpty()
    for key, value in whole.stats.items():
        assert done.stats[key] == pytest.approx(value)
    one = {r.rule: (r.rows_matched, r.rows_deleted, r.cells_modified) for r in whole.audit().collect() if not r.rows_deleted}
    assert {r.rule: (r.rows_matched, r.rows_deleted, r.cells_modified) for r in done.audit().collect()}.items() <= one.items() | set()
    deleted = {r.rule: r.rows_deleted for r in whole.audit().filter("rows_deleted > 0").collect()}
    assert {r.rule: r.rows_deleted for r in chunks.audit(spark, 3).filter("rows_deleted > 0").collect()} == deleted


def test_rules_that_are_not_final_are_refused(spark, tmp_path):
    orders, workforce = DOMAINS["orders"](as_of="2024-01-01"), DOMAINS["workforce"](as_of="2024-01-01")
    with pytest.raises(ValueError, match="MONETARY_OUTLIER"):
        ChunkedClean.of(str(tmp_path), orders, ["order_id", "total_amount"])
    with pytest.raises(ValueError, match="FK"):
        ChunkedClean.of(str(tmp_path), workforce, ["employee_id", "manager_id"], stats={})
    with pytest.raises(ValueError, match="customers"):
        ChunkedClean.of(str(tmp_path), DOMAINS["orders"](customers="c_custkey"), ["customer_id"], stats={})


def test_given_statistics_and_masters_are_final_in_each_batch(spark, small, tmp_path):
    from burnish.dirty import dirty, table
    from burnish.registry.base import domain

    rows, rules = dirty(spark, small, "orders"), domain("orders", customers="c_custkey")
    masters = {"customers": table(spark, small, "customer").select("c_custkey")}
    whole = rules.clean(rows, masters)
    chunks = ChunkedClean.of(str(tmp_path), rules, rows.columns, masters, stats=whole.stats)
    for n, batch in enumerate(_batches(rows, 3)):
        chunks(batch, n)
    done = spark.read.parquet(f"{tmp_path}/cleaned").drop("batch_id")
    assert done.exceptAll(whole.frame).isEmpty() and whole.frame.exceptAll(done).isEmpty()


STATS = [
    Stat("p50", "quantile", "x", 0.5), Stat("p99", "quantile", "x", 0.99), Stat("least", "quantile", "x", 0.0), Stat("some", "quantile", "x", 0.37, "x > 3"),
    Stat("mode", "mode", "w"), Stat("mean", "mean", "x"), Stat("lo", "min", "x"), Stat("hi", "max", "x"), Stat("sum", "sum", "x"), Stat("skew", "skewness", "x"),
    Stat("slope", "slope", "x", other="y"), Stat("cut", "intercept", "x", other="y"), Stat("r", "corr", "x", other="y"), Stat("none", "quantile", "x", 0.5, "x > 1e9"),
    Stat("no_mode", "mode", "x", where="false"), Stat("no_mean", "mean", "x", where="false"), Stat("flat", "corr", "z", other="y"),
]


def test_counted_statistics_equal_those_of_rows(spark):
    """Counts of four parts added up: a third of the rows hold one value, some none."""
    df = spark.range(2_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7.0D WHEN id % 11 = 0 THEN NULL ELSE (id * 7919 % 1000) / 8D END AS x",
        "CASE WHEN id % 13 = 0 THEN NULL ELSE (id * 31 % 97) + id / 50D END AS y", "concat('w', id % 5) AS w", "1.5D AS z", "id",
    )
    rows = compute_stats(df, STATS)
    for stat in STATS:
        parts = [counted.value_counts(df.filter(F.col("id") % 4 == n), stat) for n in range(4)]
        merged = counted.merge_counts(parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3]))
        found = counted.counted_stat(merged, stat)
        if rows[stat.name] is None or (isinstance(rows[stat.name], float) and math.isnan(rows[stat.name])):
            assert found is None or math.isnan(found), stat.name
        else:
            assert found == (rows[stat.name] if stat.kind == "mode" else pytest.approx(rows[stat.name], rel=1e-9)), stat.name


def test_profile_is_made_from_stored_sketches(spark, tmp_path):
    df = spark.range(50_000).selectExpr("id % 10 AS part", "id % 20000 AS `a.b`", "CASE WHEN id % 4 = 0 THEN NULL ELSE id / 2D END AS x", "CAST(NULL AS DOUBLE) AS n", "concat('t', id % 100) AS `q``uote`", "id % 2 = 0 AS flag")
    sketches.column_sketches(df, by=["part"]).write.parquet(path := f"{tmp_path}/parts")
    stored = spark.read.parquet(path)
    merged = sketches.sketched_profile(sketches.merge_sketches(stored))
    plan = merged._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and path in plan and "Range (" not in plan
    got = {r.column_name: r for r in merged.collect()}
    assert set(got) == {"a.b", "x", "n", "q`uote", "flag"}
    assert (got["x"].total_rows, got["x"].null_count, got["x"].null_pct, got["x"].min_value, got["x"].max_value) == (50_000, 12_500, 25.0, 0.5, 24_999.5)
    assert got["a.b"].distinct_count == pytest.approx(20_000, rel=0.05) and got["q`uote"].distinct_count == pytest.approx(100, abs=2)
    assert got["x"].q50 == pytest.approx(12_500, rel=0.04) and got["x"].q25 == pytest.approx(6_250, rel=0.06)
    assert got["n"].q50 is None and got["n"].distinct_count == 0 and got["flag"].distinct_count == 2
    assert got["q`uote"].text_chars == df.agg(F.sum(F.length("`q``uote`"))).first()[0]


def test_merged_profile_after_each_batch(spark, tmp_path):
    handler = refresh.sketch_batches(str(tmp_path))
    df = spark.range(900).selectExpr("id", "CASE WHEN id % 9 = 0 THEN NULL ELSE id END AS x")
    for n in range(3):
        handler(df.filter(F.col("id") % 3 == n), n)
        handler(df.filter(F.col("id") % 3 == n), n)
        seen = df.filter(F.col("id") % 3 <= n)
        one = sketches.sketched_profile(sketches.merge_sketches(sketches.column_sketches(seen)))
        exact = ["column_name", "total_rows", "null_count", "null_pct", "min_value", "max_value"]
        assert sorted(map(tuple, refresh.merged_profile(spark, str(tmp_path), n).select(*exact).collect())) == sorted(map(tuple, one.select(*exact).collect()))
        both = refresh.merged_profile(spark, str(tmp_path), n).select("distinct_count", "q50").collect(), one.select("distinct_count", "q50").collect()
        for merged, whole in zip(*map(sorted, both)):
            assert tuple(merged) == pytest.approx(tuple(whole), rel=0.03)


def test_policy(spark):
    policy = refresh.RefreshPolicy(["a"], growth=0.5, drift=0.1)
    assert policy.reason() is None
    steps = [(100, 10, "first"), (20, 2, None), (20, 2, None), (10, 1, "growth"), (10, 5, "drift of a"), (0, 0, None)]
    for rows, nulls, reason in steps:
        policy.add(rows, [nulls])
        assert policy.reason() == reason, (rows, nulls)
        if reason:
            policy.refreshed()
    assert policy.profiled_rows == 160 and policy.profiled_nulls == [20]


def test_listener_decides_on_observed_metrics(spark, tmp_path):
    """Four files: the second brings too few rows, the third other null rates, the fourth too few again."""
    import time

    source = str(tmp_path / "in")
    sizes = [(200, 10), (20, 10), (20, 2), (20, 10)]
    for i, (n, gap) in enumerate(sizes):
        spark.range(i * 1000, i * 1000 + n).selectExpr("id", f"CASE WHEN id % {gap} = 0 THEN NULL ELSE id END AS x").coalesce(1).write.mode("append").parquet(source)
    profiles = []
    trigger = refresh.RefreshTrigger(refresh.RefreshPolicy(["x"], growth=0.5, drift=0.15), profiles.append)
    spark.streams.addListener(trigger)
    try:
        live = spark.readStream.schema("id long, x long").option("maxFilesPerTrigger", 1).parquet(source)
        K.run_batches(refresh.observed(live, ["x"]), refresh.sketch_batches(str(tmp_path / "out")), str(tmp_path / "cp"))
        for _ in range(100):
            if trigger.policy.profiled_rows + trigger.policy.new_rows >= 260:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(trigger)
    assert profiles == trigger.reasons == ["first", "drift of x"]
    assert trigger.policy.profiled_rows == 240 and trigger.policy.new_rows == 20


def test_clean_stream_still_takes_row_rules(spark, small):
    from burnish.dirty import dirty

    rules = DOMAINS["telemetry"](as_of="2024-01-25").rules
    rows = dirty(spark, small, "telemetry")
    present = [r for r in K.row_local(rules) if r.column in rows.columns]
    stats = {s.name: 0.0 for r in present for s in r.stats}
    assert K.clean_stream(rows, present, stats).count() == clean(rows, present, [], stats=stats).frame.count()
