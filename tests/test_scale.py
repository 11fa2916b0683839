"""Operators that must stay whole and exact under hot keys and large brackets."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from burnish.operators import quantiles as Q
from burnish.operators import dedupe, skew
from burnish.operators import actions, inject
from burnish.operators.actions import flag_group, impute_group_median
from burnish.operators.compare import cell_diff
from burnish.operators.dedupe import dedupe_first, dedupe_latest, duplicate_rows, key_multiplicity
from burnish.operators.profile import modes, profile_columns
from burnish.plans.decide import classify_columns, learn_spellings, plan_to_rules
from burnish.plans.engine import clean
from burnish.plans.rules import literal
from burnish.session import materialise


@pytest.fixture(scope="module")
def skewed(spark):
    """One key and NULL hold a third of the rows each; exact copies among them."""
    random.seed(3)
    rows = []
    for i in range(6000):
        key = 1 if i % 3 == 0 else None if i % 3 == 1 else i % 500
        rows.append((i, key, float(i % 7 if i % 2 else 1)))
    return spark.createDataFrame(rows, "seq int, k int, v double").repartition(6).cache()


def test_hot_keys_include_null(skewed):
    found = skew.hot_keys(skewed, ["k"], 0.1)
    assert sorted(found, key=str) == [(1,), (None,)]


@pytest.mark.parametrize("limit", [0, 100_000])
def test_attach_keeps_every_row_and_value(skewed, limit):
    totals = skewed.filter("k IS NOT NULL").groupBy("k").agg(F.sum("v").alias("t"), F.count(F.lit(1)).alias("n"))
    out = skew.attach(skewed, totals, ["k"], max_broadcast_rows=limit)
    assert out.columns == ["seq", "k", "v", "t", "n"]
    got = sorted((r["seq"], r["k"], r["t"], r["n"]) for r in out.filter("k IS NOT NULL").collect())
    want = {r["k"]: (r["t"], r["n"]) for r in totals.collect()}
    assert out.count() == skewed.count()
    assert out.filter("k IS NULL AND t IS NOT NULL").count() == 0
    assert all((t, n) == want[k] for _, k, t, n in got)


def test_attach_salts_hot_rows(skewed, spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        totals = skewed.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
        out = skew.attach(skewed, totals, ["k"], max_broadcast_rows=0, salts=16)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id().alias("p")).count().collect()]
        assert max(sizes) < 0.6 * sum(sizes)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedupe_cuts_before_the_shuffle(skewed):
    plan = dedupe_first(skewed, ["k"], ["seq"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_dedupe_matches_pandas(skewed):
    pdf = skewed.toPandas().sort_values("seq")
    want = sorted(pdf[~pdf.duplicated(subset=["k"], keep="first")]["seq"])
    got = sorted(r["seq"] for r in dedupe_first(skewed, ["k"], ["seq"]).collect())
    assert got == want
    gone = sorted(r["seq"] for r in duplicate_rows(skewed, ["k"], ["seq"]).collect())
    assert gone == sorted(pdf[pdf.duplicated(subset=["k"], keep="first")]["seq"])
    counted = key_multiplicity(skewed, ["k"]).first()
    assert counted["total_rows"] == 6000 and counted["extra_copies"] == len(gone)


def test_dedupe_latest(spark):
    df = spark.createDataFrame([(1, "a", 5), (2, "a", 9), (3, "a", 9), (4, "b", None)], "seq int, k string, d int")
    got = {r["k"]: r["seq"] for r in dedupe_latest(df, ["k"], "d", ["seq"]).collect()}
    assert got == {"a": 2, "b": 4}


@pytest.mark.parametrize("accuracy, bracket", [(10_000, 2_000_000), (50, 20), (20, 5)])
def test_quantiles_are_exact(spark, monkeypatch, accuracy, bracket):
    """Tiny sketches and brackets force narrowing, misses and widening; the result stays."""
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "BRACKET_ROWS", bracket)
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.lognormal(3, 2, 2000), np.full(1500, 20.0), -rng.random(700)])
    rng.shuffle(values)
    rows = [(float(v), None if i % 5 == 0 else float(i % 3)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "x double, y double").repartition(4).cache()
    requests = [Q.Quantile(f"x{q}", "x", q) for q in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0)]
    requests += [Q.Quantile("y", "y"), Q.Quantile("pos", "x", 0.5, "x > 0"), Q.Quantile("none", "x", 0.5, "x > 1e12")]
    got = Q.exact_quantiles(df, requests)
    for q in (0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0):
        assert got[f"x{q}"] == pytest.approx(np.quantile(values, q), rel=1e-12)
    assert got["y"] == 1.0
    assert got["pos"] == pytest.approx(np.median(values[values > 0]), rel=1e-12)
    assert got["none"] is None


def test_grouped_median(spark):
    rng = np.random.default_rng(5)
    rows = [(g, float(rng.integers(0, 1000))) for g in ["a"] * 3000 + ["b"] * 11 + ["c"] * 4 + [None] * 8]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["m"] for r in Q.grouped_median(df, ["g"], "v", "m").collect()}
    for g in ("a", "b", "c", None):
        assert got[g] == np.median([v for k, v in rows if k == g])


@pytest.mark.parametrize("accuracy, bracket", [(10_000, 50), (20, 20), (10, 5)])
def test_grouped_median_of_hot_groups(spark, monkeypatch, accuracy, bracket):
    """Small sketches and brackets force cuts, misses and redone groups."""
    monkeypatch.setattr(Q, "ACCURACY", accuracy)
    monkeypatch.setattr(Q, "BRACKET_ROWS", bracket)
    rng = np.random.default_rng(8)
    rows = [("a", float(x)) for x in rng.lognormal(2, 2, 3000)] + [("b", float(x)) for x in rng.integers(0, 3, 800)]
    rows += [(None, float(i)) for i in range(7)] + [("c", 1.0), ("d", None)]
    df = spark.createDataFrame(rows, "`my group` string, `the value` double").repartition(4)
    got = {r[0]: r[1] for r in Q.grouped_median(df, ["my group"], "the value", "m").collect()}
    assert set(got) == {"a", "b", "c", None}
    for g in got:
        assert got[g] == pytest.approx(np.median([v for k, v in rows if k == g]), rel=1e-12)


def test_awkward_names_and_values(spark):
    rows = [("Cote d'Ivoire", 1.0), ("Cote d'Ivoire", 3.0), ("Cote d'Ivoire", None), ("b\\c", 9.0), ("b\\c", None)]
    df = spark.createDataFrame(rows, "`a b` string, `v w` double")
    listed = impute_group_median(df, "v w", ["a b"], ["Cote d'Ivoire", "b\\c"])
    assert sorted(r[1] for r in listed.collect()) == [1.0, 2.0, 3.0, 9.0, 9.0]
    assert actions.median_if_out_of_range(df, ["v w"], 0, 5).agg(F.max("`v w`")).first()[0] == 3.0
    assert actions.impute_median(df, ["v w"]).filter("`v w` IS NULL").count() == 0


def test_modes_of_many_columns_in_one_pass(spark):
    rows = [(9, "9", 1.5, True), (10, "10", 2.5, True), (9, "9", 2.5, False), (10, "10", 1.5, None), (None, None, None, None)]
    df = spark.createDataFrame(rows, "n bigint, t string, d double, b boolean")
    assert modes(df, ["n", "t", "d", "b"]) == {"n": 9, "t": "10", "d": 1.5, "b": True}
    assert actions.impute_mode(df, ["n", "t"]).filter("n IS NULL OR t IS NULL").count() == 0


def test_statistics_keep_their_type(spark):
    from datetime import date, datetime
    from decimal import Decimal

    values = [2**60 + 1, date(2024, 2, 29), datetime(2024, 1, 2, 3, 4, 5, 678), Decimal("12.340"), True, "it's \\", 1.5, 10**30]
    row = spark.range(1).selectExpr(*[literal(v) for v in values]).first()
    assert list(row) == values and literal(None) == "CAST(NULL AS DOUBLE)"


def test_nested_columns_count_for_the_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_TEXT_BYTES", 1000)
    flat = spark.range(10).selectExpr("id", "repeat('x', 200) AS t")
    assert not skew.is_small(flat) and skew.is_small(flat.select("id"))
    assert not skew.is_small(flat.selectExpr("named_struct('a', t) AS s")) and not skew.is_small(flat.selectExpr("array(t) AS s"))


def test_clustered_hot_rows_are_spread(spark):
    """All hot rows in one input partition: the salt must not follow the partition."""
    df = spark.range(2000, numPartitions=1).selectExpr("7 AS k", "id AS v")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = skew.attach(df, spark.range(1).selectExpr("7 AS k", "1 AS t"), ["k"], max_broadcast_rows=0, salts=16)
        assert out.count() == 2000 and out.select(F.spark_partition_id()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tied_copies_are_listed(spark):
    rows = [(1, "a", "x"), (1, "a", "x"), (1, "a", "y"), (1, "b", "x"), (None, "a", "z"), (None, "a", "z"), (2, "a", "x")]
    df = spark.createDataFrame(rows, "k int, o string, v string")
    kept, gone = dedupe_first(df, ["k"], ["o"]), duplicate_rows(df, ["k"], ["o"])
    assert kept.count() + gone.count() == df.count()
    assert sorted(kept.unionByName(gone).collect(), key=str) == sorted(df.collect(), key=str)


def test_cell_diff_pairs_first_rows(spark):
    raw = spark.createDataFrame([("o1", 1, "x"), ("o1", 2, "y"), ("o1", 2, "y"), (None, 1, "n"), ("o2", 1, "z"), ("o3", 1, "q")], "k string, seq int, v string")
    cleaned = spark.createDataFrame([("o1", 1, "x"), (None, 1, "N"), ("o3", 1, None), ("o4", 1, "new")], "k string, seq int, v string")
    diff = cell_diff(raw, cleaned, ["k"], ["v"], ["seq"])
    got = sorted(((r.k, r.change_type, r.raw_value, r.cleaned_value) for r in diff.collect()), key=str)
    want = [("o1", "ROW_DELETED", None, None)] * 2 + [(None, "CHANGED", "n", "N"), ("o2", "ROW_DELETED", None, None), ("o3", "NULLED", "q", None), ("o4", "ROW_ADDED", None, None)]
    assert got == sorted(want, key=str)
    assert "FullOuter" not in diff._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("pct", [0.5, 5, 8, 40, 70])
def test_injection_rates(spark, pct):
    df = spark.range(10_000).selectExpr("id", "concat('k', id) AS word", "1.0D AS v", "id * 7919 AS sparse")
    hits = [r[0] for r in inject.inject_nulls(df, "v", "id", pct).filter("v IS NULL").collect()]
    assert abs(len(hits) - 100 * pct) <= 1
    assert max(abs(sum(h < n for h in hits) - n * pct / 100) for n in range(0, 10_001, 137)) <= 1
    for key in ("sparse", "word"):
        copied = inject.inject_dup_keys(df, key, key, pct)
        lost = 10_000 - copied.select(key).distinct().count()
        assert abs(lost - 100 * pct) <= 0.05 * 100 * pct + 60, key
    assert inject.inject_variants(df, "word", "word", ["a", "b"]).select("word").distinct().count() == 2


def test_group_median_fill(spark):
    rows = [("EUR", 1.0), ("EUR", 3.0), ("EUR", None), ("USD", None), ("XXX", 4.0), ("XXX", None)]
    df = spark.createDataFrame(rows, "currency string, fx double")
    listed = impute_group_median(df, "fx", ["currency"], ["EUR"])
    assert sorted(listed.collect(), key=str) == sorted(
        [("EUR", 1.0), ("EUR", 3.0), ("EUR", 2.0), ("USD", None), ("XXX", 4.0), ("XXX", None)], key=str
    )
    every = impute_group_median(df, "fx", ["currency"])
    assert every.filter("fx IS NULL").count() == 1


def test_flag_group_hot_group(spark, monkeypatch):
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    rows = [(1, 1.0, 1.0)] * 500 + [(1, 5.0, 1.0)] + [(2, 2.0, 2.0)] * 300 + [(3, 1.0, 9.0), (None, 1.0, 7.0)]
    df = spark.createDataFrame(rows, "je int, d double, c double").repartition(4)
    out = flag_group(df, "je", "d", "c", "OFF")
    got = {(r["je"], r["je_flag"]): r["count"] for r in out.groupBy("je", "je_flag").count().collect()}
    assert got == {(1, "OFF"): 501, (2, None): 300, (3, "OFF"): 1, (None, None): 1}


def _largest_block(df, column, key):
    placed, alone = inject._blocks(df, column, key)
    return max(r["count"] for r in placed.groupBy("_block").count().collect()), 0 if alone is None else alone.count()


def test_key_blocks_follow_rows(spark):
    base = spark.range(6_000).selectExpr("id AS k", "id AS v")
    far = base.union(spark.createDataFrame([(10**15, -1)], "k long, v long"))
    hot = base.union(spark.range(5_000).selectExpr("77 AS k", "id + 100000 AS v"))
    copies = base.union(spark.range(5_000).selectExpr("77 AS k", "77 AS v"))
    bent = base.selectExpr("IF(k % 3 = 0, NULL, CAST(exp(k / 180) AS BIGINT)) AS k", "v")
    for df, lonely in ((far, 0), (hot, 0), (copies, 5_001), (bent, 0)):
        most, alone = _largest_block(df, "v", "k")
        assert most <= 2 * inject.BLOCK and alone == lonely
        out = inject.inject_dup_keys(df, "v", "k", 10)
        assert out.count() == df.count()
        lost = df.select("v").distinct().count() - out.select("v").distinct().count()
        spread = df.select("v").distinct().count()
        assert abs(lost - spread / 10) <= 60


def test_spellings_are_joined(spark):
    """100,000 spellings reach the rows by a join; none is written into the plan."""
    rows = spark.range(200_000).selectExpr("id", "concat('Town ', CAST(id % 50000 AS STRING)) AS city")
    odd = rows.selectExpr("id + 200000 AS id", "upper(city) AS city").filter("id % 4 = 0")
    df = rows.unionByName(odd).withColumn("city", F.when(F.col("id") % 1000 != 7, F.col("city")))
    df = materialise(df, "towns")
    plan = spark.createDataFrame([("city", "CATEGORY", 0.1, None, "STANDARDIZE", "CATEGORY_CONSISTENCY", None)], "column_name string, column_class string, null_pct double, predictor string, action string, rule string, detail string")
    spellings = learn_spellings(df, plan)
    rules, _ = plan_to_rules(plan, spellings=spellings)
    done = clean(df, rules, ["id"], spellings=spellings)
    text = done.frame._jdf.queryExecution().optimizedPlan().toString()
    assert "TOWN" not in text.upper() and len(text) < 20_000
    assert done.frame.columns == ["id", "city"]
    got = done.frame.selectExpr("count(*) n", "count(city) m", "count(DISTINCT city) d", "count_if(city LIKE 'TOWN%') u").first()
    assert (got.n, got.m, got.d, got.u) == (df.count(), df.filter("city IS NOT NULL").count(), 49_950, 0)
    assert done.audit().first()["cells_modified"] == df.filter("city LIKE 'TOWN%'").count()


@pytest.mark.parametrize("rows", [5, 80, 5_000])
def test_classes_do_not_follow_size(spark, rows):
    df = spark.range(rows).selectExpr("concat('note ', CAST(id AS STRING)) AS note", "'x' AS status")
    got = {r["column_name"]: r["column_class"] for r in classify_columns(profile_columns(df)).collect()}
    assert got == {"note": "TEXT", "status": "CATEGORY"}


def test_few_matches_leave_the_other_rows_in_place(spark):
    """Rows that cannot have a match in a large lookup are not shuffled; results are those of a plain join."""
    df = spark.range(0, 20_000, numPartitions=4).selectExpr("CASE WHEN id % 11 = 0 THEN NULL WHEN id % 3 = 0 THEN 7 ELSE id % 5000 - 2500 END AS k", "id AS v")
    lookup = df.filter("k % 50 = 7").groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = skew.attach(df, lookup, ["k"], max_broadcast_rows=0, few=True)
    plain = skew.attach(df, lookup, ["k"])
    assert out.columns == plain.columns and out.count() == 20_000 and out.exceptAll(plain).isEmpty()
    near, far = skew._split(df, materialise(lookup, "l"), ["k"])
    assert far.count() > 12_000 and near.join(lookup, "k", "left_semi").count() == df.join(lookup, "k", "left_semi").count()
    assert "hashpartitioning" not in far._jdf.queryExecution().executedPlan().toString()


def test_copies_are_removed_once(spark):
    """Statistics and result read the stored first rows; the window over the wide rows runs once."""
    from burnish.plans.domains import DOMAINS

    df = spark.range(400).selectExpr(
        "concat('t', id % 300) AS transaction_id", "id % 40 AS journal_entry_id", "TIMESTAMP_NTZ '2024-01-01' AS posting_date",
        "id * 1.5D AS debit_amount", "id * 1.5D + IF(id % 40 = 3, 1, 0) AS credit_amount", "1 AS intercompany_flag",
    )
    done = clean(df, [r for r in DOMAINS["ledger"]().rules if r.stage == "key" or r.name in ("JOURNAL_BALANCE", "INTERCOMPANY")], ["posting_date"], balances=DOMAINS["ledger"]().balances)
    assert "Window" not in done.frame._jdf.queryExecution().optimizedPlan().toString()
    assert done.frame.count() == 300
    assert {r[0] for r in done.frame.filter("journal_entry_id_flag IS NOT NULL").select("journal_entry_id").distinct().collect()} == {3}


def test_integers_are_counted_as_they_are(spark):
    """An integer is its own cell and needs no hashes; equal numbers of other types stay one value."""
    rows = [(1, -0.0, 1.5, "a", True), (2, 0.0, 2.5, "a", None), (2**60 + 1, float("nan"), None, "b", True), (2**60, float("nan"), 1.5, None, True)]
    odd = spark.createDataFrame(rows, "w bigint, x double, y float, t string, f boolean")
    got = {r["column_name"]: (r["total_rows"], r["null_count"], r["distinct_count"]) for r in profile_columns(odd).collect()}
    assert got == {"w": (4, 0, 4), "x": (4, 0, 2), "y": (4, 1, 2), "t": (4, 1, 2), "f": (4, 1, 1)}
    plan = profile_columns(odd.select("w"))._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64" not in plan


def test_only_repeated_keys_are_ordered(spark):
    """Rows whose key occurs once stay in place; the result is that of the window over all rows."""
    df = spark.range(0, 40_000, numPartitions=4).selectExpr(
        "CASE WHEN id % 1000 = 7 THEN NULL WHEN id % 50 = 3 THEN concat('k', id - 3) ELSE concat('k', id) END AS k", "id % 3 = 0 AS f", "-id AS o"
    )
    repeated = dedupe.repeated_keys(df, ["k"])
    assert {r["_n"] for r in repeated.collect()} == {2, 40} and repeated.filter("k IS NULL").first()["_n"] == 40
    out = dedupe.dedupe_rest(df, ["k"], ["o"], repeated)
    want = dedupe_first(df, ["k"], ["o"])
    assert out.count() == want.count() and out.exceptAll(want).isEmpty()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "hashpartitioning" not in plan
    shared, alone = skew._split(df, repeated, ["k"])
    assert alone.count() > 30_000 and shared.count() + alone.count() == 40_000
    single = df.filter("o % 50 = -1")
    assert dedupe.dedupe_rest(single, ["k"], ["o"], dedupe.repeated_keys(single, ["o"])) is single


def test_keys_that_hash_differently_are_ordered_as_a_whole(spark):
    """Zero and minus zero, or letters of a collation, are one key with different hashes."""
    df = spark.createDataFrame([(0.0, "a", 1), (-0.0, "A", 2), (1.0, "b", 3)], "x double, t string collate UTF8_LCASE, o int")
    for key in ("x", "t"):
        out = dedupe.dedupe_rest(df, [key], ["o"], dedupe.repeated_keys(df, [key]))
        assert sorted(r["o"] for r in out.collect()) == [1, 3]


def test_cleaning_sorts_only_rows_with_copies(spark, tmp_path):
    """What cleaning writes grows with the copies, and the audit and the raw score count the same ones."""
    from burnish.plans.domains import DOMAINS
    from burnish.plans.score import measure_layer

    domain = DOMAINS["workforce"]("2024-01-01")
    df = spark.range(20_000).selectExpr(
        "id AS row_seq", "IF(id % 100 = 9, id - 9, id) AS employee_id", "CAST(NULL AS BIGINT) AS manager_id", "'x' AS department",
        "concat('name ', id) AS full_name", "concat('n', id, '@x.org') AS email", "'active' AS employment_status", "1D AS base_salary", "CAST(id % 7 AS DOUBLE) AS perf_rating_2024",
        "TIMESTAMP_NTZ '2020-01-01' AS hire_date", "CAST(NULL AS TIMESTAMP_NTZ) AS termination_date", "1D AS bonus_target",
        "1D AS equity_grant", "9D AS total_comp", "9D AS salary_band_max", "1D AS pto_days_used", "1D AS pto_days_remaining",
    )
    df.write.parquet(f"{tmp_path}/w")
    df = spark.read.parquet(f"{tmp_path}/w")
    done = domain.clean(df)
    kept = [f for f in done.frame.inputFiles() if "/kept-" in f]
    assert kept and spark.read.parquet(*kept).count() < 4_000
    assert done.frame.count() == 19_800
    assert done.audit().filter("rule = 'PK_VIOLATION'").first()["rows_deleted"] == 200
    known = done.repeated(domain.key)
    assert known.count() == 200
    counted, told = (measure_layer(df, domain, repeated=r).scores.collect() for r in (None, known))
    assert counted == told
