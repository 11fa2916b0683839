"""The catalog of measured columns after changes of schema."""

import pytest
from pyspark.sql import functions as F

from burnish.plans import catalog as K
from burnish.plans import decide as T
from burnish.session import shared_path


@pytest.fixture(scope="module")
def sales(spark):
    """Two numbers that follow each other, one of them missing in a fifth of the rows, and a negative price."""
    df = spark.range(400).select(
        F.col("id").alias("row_id"),
        (F.col("id") % 37).cast("double").alias("load"),
        F.when(F.col("id") % 5 > 0, (F.col("id") % 37) * 2.0 + 1).alias("usage"),
        ((F.col("id") * 7919) % 11).cast("double").alias("noise"),
        F.when(F.col("id") % 50 == 0, -1.0).otherwise(5.0).alias("price"),
        F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("kind"),
    )
    return spark.createDataFrame(df.collect(), df.schema)


def rows(df):
    return sorted(map(str, df.collect()))


def whole(df):
    return rows(T.decide(T.measure(df)))


def test_versions_replace_themselves(spark, sales):
    path = shared_path(spark, "catalog")
    measured = T.measure(sales)
    K.save_version(measured, path, 1)
    K.save_version(measured.filter("column_name <> 'kind'"), path, 2)
    K.save_version(measured.filter("column_name <> 'price'"), path, 2)
    assert K.load_version(spark, path, 1).count() == 6
    assert {r.column_name for r in K.load_version(spark, path).collect()} == set(sales.columns) - {"price"}


def test_only_changed_columns_are_scanned(spark, sales, monkeypatch):
    known = T.measure(sales.drop("noise").withColumn("price", F.col("price").cast("string")).withColumn("old", F.lit(1)))
    seen = []
    plain = K.profile_columns
    monkeypatch.setattr(K, "profile_columns", lambda df: seen.append(df.columns) or plain(df))
    measured, drift = K.refresh(sales, known)
    assert seen == [["noise", "price"]]
    assert {r.column_name: r.change for r in drift.collect()} == {"noise": "ADDED", "price": "RETYPED", "old": "REMOVED"}
    assert rows(T.decide(measured)) == whole(sales)
    same, none = K.refresh(sales, T.measure(sales))
    assert seen == [["noise", "price"]] and none.count() == 0 and rows(T.decide(same)) == whole(sales)


@pytest.mark.parametrize("gone", [["load"], ["noise"], ["load", "noise"], ["kind", "price"]])
def test_predictors_come_and_go(sales, gone):
    rest = sales.drop(*gone)
    assert rows(K.reclassify(rest, T.measure(sales))[0]) == whole(rest)
    assert rows(K.reclassify(sales, T.measure(rest))[0]) == whole(sales)


def test_decisions_change_with_other_columns(sales):
    known = T.measure(sales.drop("load"))
    plan, changes = K.reclassify(sales.withColumn("refund_code", F.col("kind")), known)
    found = {r.column_name: r for r in changes.collect()}
    assert set(found) == {"load", "usage", "price", "refund_code"}
    assert found["usage"].change is None and (found["usage"].old_actions, found["usage"].new_actions) == ("IMPUTE_MEDIAN", "IMPUTE_REGRESSION")
    assert (found["price"].old_actions, found["price"].new_actions) == ("FLAG_NEGATIVE", "CONVERT_TO_POSITIVE")
    assert (found["load"].old_class, found["load"].new_class) == (None, "NUMERIC")
    assert rows(plan) == whole(sales.withColumn("refund_code", F.col("kind")))


def test_empty_catalogs_and_given_classes(sales):
    nothing = T.measure(sales).limit(0)
    assert rows(K.reclassify(sales, nothing)[0]) == whole(sales)
    plan, changes = K.reclassify(sales, T.measure(sales.drop("kind")), overrides={"kind": "TEXT"})
    assert plan.filter("column_name = 'kind'").count() == 0
    assert [(r.column_name, r.new_class, r.new_actions) for r in changes.collect()] == [("kind", "TEXT", None)]
    other = sales.select(F.col("row_id").alias("a"), F.col("kind").alias("b"))
    assert rows(K.reclassify(other, T.measure(sales))[0]) == whole(other)
