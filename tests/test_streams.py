"""Incremental forms, several files arriving one batch at a time."""

import pytest
from pyspark.sql import functions as F

from burnish.plans.domains import DOMAINS
from burnish.plans.rules import Check
from burnish.streaming import incremental as K


@pytest.fixture()
def arriving(spark, tmp_path):
    """Three files of readings; keys repeat across files."""
    source = str(tmp_path / "in")
    for part in range(3):
        df = spark.range(part * 40, part * 40 + 60).select(
            F.col("id").alias("seq"),
            (F.col("id") % 50).alias("k"),
            (F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("id").cast("int"))).alias("ts"),
            F.lit(part).alias("part"),
        )
        df.coalesce(1).write.mode("append").parquet(source)
    return source, spark.read.parquet(source)


def _stream(spark, source, schema):
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)


def test_dedupe_across_batches(spark, arriving, tmp_path):
    source, table = arriving
    out = str(tmp_path / "out")
    handler = K.dedupe_into(out, ["k"], ["seq"])
    K.run_batches(_stream(spark, source, table.schema), handler, str(tmp_path / "cp"))
    done = spark.read.parquet(out)
    assert done.count() == 50 and done.select("k").distinct().count() == 50
    assert done.select("batch_id").distinct().count() >= 1
    # A repeated batch overwrites itself.
    last = done.agg(F.max("batch_id")).first()[0]
    handler(spark.read.parquet(source).filter("k > 1000"), last + 1)
    assert spark.read.parquet(out).count() == 50


def test_null_keys_are_kept_once(spark, tmp_path, monkeypatch):
    from burnish.operators import skew

    out = str(tmp_path / "out")
    handler = K.dedupe_into(out, ["a", "b"], ["seq"], compact_every=2)
    for n in range(6):
        monkeypatch.setattr(skew, "BROADCAST_ROWS", 0 if n == 3 else 200_000)
        batch = spark.createDataFrame([(n * 10, None, 1), (n * 10 + 1, None, None), (n * 10 + 2, n // 2, 1)], "seq int, a int, b int")
        handler(batch, n)
        handler(batch, n)
    done = spark.read.parquet(out)
    assert sorted(r["seq"] for r in done.collect()) == [0, 1, 2, 22, 42]
    assert done.columns == ["seq", "a", "b", "batch_id"]


def test_history_is_not_shuffled_for_a_small_batch(spark):
    history, asked = spark.range(1000).toDF("_k0"), spark.range(5).toDF("k")
    plan = K.seen_before(history, asked, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan


def test_dedupe_within_watermark(spark, arriving, tmp_path):
    source, table = arriving
    first = K.dedupe_stream(_stream(spark, source, table.schema), ["k"], "ts", "1 day")
    K.run_available(first, str(tmp_path / "out"), str(tmp_path / "cp"))
    done = spark.read.parquet(str(tmp_path / "out"))
    assert done.count() == 50 and "_event_time" not in done.columns


def test_windowed_quality_streams_like_a_table(spark, arriving, tmp_path):
    source, table = arriving
    checks = [Check("late", "validity", "INFO", "k", "k > 25")]
    batch = {r["window_start"]: (r["total_rows"], r["validity_rows"]) for r in K.windowed_quality(table, "ts", "30 minutes", checks).collect()}
    live = K.windowed_quality(_stream(spark, source, table.schema), "ts", "30 minutes", checks, delay="1 hour")
    query = live.writeStream.outputMode("complete").format("memory").queryName("wq").trigger(availableNow=True)
    query.option("checkpointLocation", str(tmp_path / "cp")).start().awaitTermination()
    got = {r["window_start"].replace(tzinfo=None): (r["total_rows"], r["validity_rows"]) for r in spark.table("wq").collect()}
    assert got == batch


def test_refresh_writes_profile_and_score(spark, tmp_path, small):
    from burnish.dirty import dirty

    handler = K.on_refresh(DOMAINS["catalog"](), str(tmp_path))
    batch = dirty(spark, small, "catalog")
    handler(batch, 0)
    handler(batch, 0)
    assert spark.read.parquet(f"{tmp_path}/score").count() == 1
    assert spark.read.parquet(f"{tmp_path}/profile").count() == len(batch.columns)


def _keys(spark, start, n):
    return spark.range(start, start + n).select(F.col("id").alias("k"))


def test_history_opens_a_constant_number_of_files(spark, tmp_path):
    """Thirty batches of new keys and one early key: what is read does not grow with the history."""
    from burnish.streaming.history import KeyHistory

    history = KeyHistory(str(tmp_path), ["k"], compact_every=8)
    opened = []
    for n in range(30):
        batch = _keys(spark, n * 50, 50).union(_keys(spark, 7, 1))
        history.compact(n, batch.schema)
        seen = history.seen(batch, n)
        opened.append(len(history.opened))
        found = set() if seen is None else {r[0] for r in seen.collect()}
        assert n == 0 or 7 in found
        history.add(n, _keys(spark, n * 50, 50))
    assert opened[0] == 0 and max(opened[1:]) <= 3 and sum(opened[1:]) <= 29 + 6


def test_history_finds_every_key_over_many_buckets(spark, tmp_path, monkeypatch):
    from burnish.streaming import history as H

    monkeypatch.setattr(H, "KEYS_A_MAP", 16)
    history = H.KeyHistory(str(tmp_path), ["a", "b"], buckets=8, compact_every=2)
    rows = lambda n: spark.range(n * 100, n * 100 + 100).selectExpr("CASE WHEN id % 10 = 0 THEN NULL ELSE id END AS a", "CAST(id % 7 AS STRING) AS b")
    for n in range(5):
        history.compact(n, rows(0).schema)
        history.add(n, rows(n).distinct())
    asked = rows(3).distinct()
    found = {tuple(r) for r in history.seen(asked, 5).collect()}
    assert {tuple(r) for r in asked.collect()} <= found
    strangers = spark.range(10**6, 10**6 + 3).selectExpr("id AS a", "'x' AS b")
    assert len(history.may_hold(strangers, 5)) <= 2
    # Batches may come again: generations are found by number, and later ones are not read.
    assert all("batch-4" not in p for p in history.may_hold(rows(4), 4))


def test_rules_that_need_other_rows_are_refused(spark):
    rules = DOMAINS["orders"](as_of="2024-01-01").rules
    with pytest.raises(ValueError, match="PK_VIOLATION"):
        K.clean_stream(spark.range(1), rules, {})


def test_a_part_arrives_in_many_files(spark, tmp_path):
    """A part is one batch, but neither written nor read by a single task; an empty part is a batch too."""
    from burnish.registry.streams import in_order

    df = spark.range(0, 900, numPartitions=6).selectExpr("id", "CASE WHEN id % 2 = 0 THEN 0 ELSE 2 END AS part")
    seen = {}

    def handler(batch, batch_id):
        seen[batch_id] = (batch.count(), batch.agg(F.min("part"), F.max("part")).first(), len(batch.inputFiles()))

    in_order(df, str(tmp_path / "in"), "part", handler, str(tmp_path / "cp"))
    assert {k: v[:2] for k, v in seen.items()} == {0: (450, (0, 0)), 1: (0, (None, None)), 2: (450, (2, 2))}
    files = [r[0] for r in spark.read.parquet(str(tmp_path / "in")).groupBy(F.input_file_name()).count().select("count").collect()]
    assert len(files) >= 8 and max(files) <= 150
