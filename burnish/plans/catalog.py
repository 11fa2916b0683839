"""A versioned catalog of measured columns, brought up to date after a change of schema.

A version holds one row per column: type, class and everything the decision tree reads.  After
a change of schema only columns that are new or have another type are scanned; what the tree
decides is then worked out from the catalog alone, so decisions that hang on other columns (a
refund column that came or went, a lost predictor) change with them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.operators.profile import profile_columns
from burnish.plans.decide import decide, measure, predictors, schema_drift, wants_predictor
from burnish.session import materialise


def save_version(measured: DataFrame, path: str, version: int) -> None:
    """Write one version; writing the same version again replaces it."""
    measured.drop("version").write.mode("overwrite").parquet(f"{path}/version={version}")


def load_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The version asked for, or the latest."""
    stored = spark.read.option("basePath", path).parquet(path)
    if version is None:
        version = stored.agg(F.max("version")).first()[0]
    return stored.filter(F.col("version") == version).drop("version")


def refresh(
    df: DataFrame, catalog: DataFrame, as_of: str | None = None, overrides: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(measured columns of ``df``, drift): the catalog brought up to the schema of ``df``.

    Columns that are neither added nor retyped keep their row, so ``df`` is scanned for the
    others alone; without any it is not scanned.  Predictors are looked for again where a change
    can matter: in changed columns, in those whose predictor is gone, and in every column that
    wants one when a numeric column came.  ``overrides`` are classes as in ``measure``.  An empty
    catalog has all columns added; a table without columns in common keeps none of it.
    """
    drift = materialise(schema_drift(df, catalog), "drift")
    # As many rows as columns have changed.
    changes = {r["column_name"]: r["change"] for r in drift.select("column_name", "change").collect()}
    fresh = [c for c in df.columns if changes.get(c) in ("ADDED", "RETYPED")]
    kept = catalog.filter(F.col("column_name").isin([c for c in df.columns if c not in fresh]))
    if not changes:
        return kept, drift
    if fresh:
        part = df.select(*[F.col(f"`{c}`") for c in fresh])
        profile = materialise(profile_columns(part), "profile")
        new = measure(part, as_of, overrides, profile=profile).select(*catalog.columns)
        kept = materialise(kept.unionByName(new), "measured")
    return _with_predictors(df, kept, fresh), drift


def _with_predictors(df: DataFrame, measured: DataFrame, fresh: list[str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    rows = measured.select("column_name", "predictor", (F.col("column_class") == "NUMERIC").alias("plain"), wants_predictor().alias("wants")).collect()
    plain = sorted(r["column_name"] for r in rows if r["plain"] and isinstance(kinds[r["column_name"]], T.NumericType))
    came = any(c in plain for c in fresh)
    again = [
        r["column_name"]
        for r in rows
        if r["column_name"] in plain and r["wants"] and (came or r["predictor"] not in (None, *plain))
    ]
    stale = F.col("column_name").isin(again) if again else F.lit(False)
    kept = measured.withColumn("predictor", F.when(~stale, F.col("predictor")))
    if not again or len(plain) < 2:
        return kept
    best = predictors(df, again, plain).withColumnRenamed("predictor", "_found")
    return kept.join(F.broadcast(best), "column_name", "left").withColumn("predictor", F.coalesce("predictor", "_found")).select(*measured.columns)


def reclassify(
    df: DataFrame, catalog: DataFrame, as_of: str | None = None, overrides: dict[str, str] | None = None
) -> tuple[DataFrame, DataFrame]:
    """(plan, differences) after a change of schema.

    The plan is what ``decide`` returns for the whole table.  The differences have one row per
    column whose type, class or actions are not those of the catalog: ``column_name, change,
    old_class, new_class, old_actions, new_actions``; ``change`` is null where only the decision is new.
    """
    measured, drift = refresh(df, catalog, as_of, overrides)
    measured = materialise(measured, "refreshed")
    plan = decide(measured)

    def summary(rows: DataFrame, decided: DataFrame, prefix: str) -> DataFrame:
        acts = decided.groupBy("column_name").agg(F.array_join(F.array_sort(F.collect_set("action")), ",").alias(f"{prefix}_actions"))
        return rows.select("column_name", F.col("column_class").alias(f"{prefix}_class")).join(acts, "column_name", "left")

    both = summary(catalog, decide(catalog), "old").join(summary(measured, plan, "new"), "column_name", "full_outer")
    both = both.join(drift.select("column_name", "change"), "column_name", "left")
    differs = F.col("change").isNotNull() | ~F.col("old_class").eqNullSafe(F.col("new_class")) | ~F.col("old_actions").eqNullSafe(F.col("new_actions"))
    return plan, both.filter(differs).select("column_name", "change", "old_class", "new_class", "old_actions", "new_actions")
