"""Loading files into tables, checking counts, and storing reports."""

from __future__ import annotations

import time
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burnish.operators.compare import reconcile_load
from burnish.sources.files import normalise_null_tokens, read_csv_table, write_table
from burnish.sources.typing import cast_or_reject, infer_types, inferred_schema, sanitise_names

REPORT_COLUMNS = (
    "table_name string, profiled_at timestamp, raw_rows bigint, cleaned_rows bigint, rows_deleted bigint, "
    "rows_modified bigint, quality_score_raw double, quality_score_clean double, grade_raw string, "
    "grade_clean string, issues_critical bigint, issues_warning bigint, full_profile_json string, "
    "created_at timestamp"
)


def ingest(
    spark: SparkSession,
    path: str,
    namespace: str,
    name: str,
    sample_rows: int | None = None,
    store: str | None = None,
    schema: dict[str, str] | None = None,
):
    """CSV to a typed table: (table, table of rejected rows, load result row).

    Types are inferred over all rows; ``schema`` declares some or all of them instead.
    Rows that do not fit are kept in ``<name>_rejects`` and counted in the result: LOADED
    without any, PARTIAL with some, EMPTY when nothing else is left.
    """
    started = time.monotonic()
    text = normalise_null_tokens(sanitise_names(read_csv_table(spark, path)))
    declared = schema or {}
    guessed = text.drop(*declared)
    types = {**(inferred_schema(infer_types(guessed, sample_rows)) if guessed.columns else {}), **declared}
    ok, rejected = cast_or_reject(text, types)
    loaded = spark.table(write_table(ok, namespace, name, path=store))
    kept_aside = write_table(rejected, namespace, f"{name}_rejects", path=store and f"{store}-rejects")
    rejects = spark.table(kept_aside)
    rows, lost = loaded.count(), rejects.count()
    status = "LOADED" if not lost else "PARTIAL" if rows else "EMPTY"
    result = (f"{namespace}.{name}", rows, lost, round(time.monotonic() - started, 3), status, None)
    return loaded, rejects, result


def load_all(jobs: dict[str, Callable[[], tuple]]) -> list[tuple]:
    """Run each load; a failure is recorded and the others still run."""
    results = []
    for name, job in jobs.items():
        started = time.monotonic()
        try:
            results.append(job()[2])
        except Exception as error:  # noqa: BLE001 - one table must not stop the rest
            results.append((name, 0, 0, round(time.monotonic() - started, 3), "FAILED", str(error)))
    return results


def load_summary(spark: SparkSession, results: list[tuple]) -> tuple[DataFrame, DataFrame]:
    """Per-table results, and totals per status."""
    frame = spark.createDataFrame(
        results,
        "table_name string, row_count bigint, rejected_rows bigint, seconds double, status string, error string",
    )
    totals = frame.groupBy("status").agg(
        F.count(F.lit(1)).alias("tables"),
        F.sum("row_count").alias("row_count"),
        F.sum("rejected_rows").alias("rejected_rows"),
        F.sum("seconds").alias("seconds"),
    )
    return frame, totals


def reconcile_results(results: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows a source should hold against loaded plus rejected ones, from the load results."""
    return reconcile_load(
        expected, results.select("table_name", "row_count"), results.select("table_name", "rejected_rows")
    )


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    pieces = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, pieces)


def verify_counts(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """Counted against expected rows: PASS, or FAIL with the reason."""
    return expected.join(actual, "table_name", "full_outer").select(
        "table_name",
        "row_count",
        "expected_rows",
        F.when(F.col("row_count") == F.col("expected_rows"), F.lit("PASS"))
        .otherwise(F.lit("FAIL - unexpected count"))
        .alias("load_status"),
    )


def verify_outputs(spark: SparkSession, expected: list[tuple[str, str]]) -> DataFrame:
    """Which of the expected (namespace, table) pairs exist and hold rows."""
    rows = []
    for namespace, name in expected:
        present = spark.catalog.tableExists(f"{namespace}.{name}")
        rows.append((namespace, name, present, present and not spark.table(f"{namespace}.{name}").isEmpty()))
    return spark.createDataFrame(rows, "namespace string, table_name string, present boolean, has_rows boolean")


def profile_document(
    meta: DataFrame, columns: DataFrame, issues: DataFrame, recommended: DataFrame, scores: DataFrame, dropped: list[str] = ()
) -> DataFrame:
    """One nested JSON text per table, from metadata-sized frames."""
    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.agg(F.sort_array(F.collect_list(F.struct("*"))).alias(name))

    return meta.select(
        "table_name",
        F.to_json(
            F.struct(
                F.struct(*[c for c in meta.columns]).alias("profile_metadata"),
                rows(columns, "v").scalar().alias("column_profiles"),
                rows(issues, "v").scalar().alias("issues_summary"),
                rows(recommended, "v").scalar().alias("cleaning_recommendations"),
                rows(scores, "v").scalar().alias("pre_post_comparison"),
                F.array(*[F.lit(c) for c in dropped]).cast("array<string>").alias("columns_dropped"),
            )
        ).alias("full_profile_json"),
    )


def write_profile(document: DataFrame, path: str) -> None:
    """Append the document (one JSON object per table)."""
    document.select(F.col("full_profile_json").alias("value")).write.mode("append").text(path)


def report_row(document: DataFrame, scores: DataFrame, totals: DataFrame, issues: DataFrame) -> DataFrame:
    """One row of the quality-reports table, from a document, two score rows and the audit."""

    def of(layer: str, column: str):
        return scores.filter(F.col("layer") == layer).agg(F.first(column)).scalar()

    def found(severity: str):
        return issues.agg(F.coalesce(F.sum(F.when(F.col("severity") == severity, F.col("issue_rows"))), F.lit(0))).scalar()

    return document.select(
        "table_name",
        F.current_timestamp().alias("profiled_at"),
        of("raw", "total_rows").alias("raw_rows"),
        of("cleaned", "total_rows").alias("cleaned_rows"),
        totals.select("rows_deleted").scalar().alias("rows_deleted"),
        totals.select("rows_modified").scalar().alias("rows_modified"),
        of("raw", "overall").alias("quality_score_raw"),
        of("cleaned", "overall").alias("quality_score_clean"),
        of("raw", "grade").alias("grade_raw"),
        of("cleaned", "grade").alias("grade_clean"),
        found("CRITICAL").alias("issues_critical"),
        found("WARNING").alias("issues_warning"),
        "full_profile_json",
        F.current_timestamp().alias("created_at"),
    )


def as_variant(report: DataFrame) -> DataFrame:
    """Report rows with the nested document as a VARIANT, so that stored reports answer queries by path.

    A document that is null or no JSON becomes null; the other columns stay.
    """
    return report.withColumn("full_profile_json", F.try_parse_json("full_profile_json"))


def document_values(values: dict[str, tuple[str, str]]) -> list[Column]:
    """One column per name from (path, type); a path that is not there, or holds another type, is null."""
    return [F.try_variant_get("full_profile_json", path, kind).alias(n) for n, (path, kind) in values.items()]


def document_rows(reports: DataFrame, path: str, values: dict[str, tuple[str, str]], keep: tuple[str, ...] = ("table_name",)) -> DataFrame:
    """One row per entry of the list at ``path`` of every report, with the values of the entry's own paths.

    Reports without that list, or with an empty one, have no rows.
    """
    entries = reports.select(*keep, F.explode(F.try_variant_get("full_profile_json", path, "array<variant>")).alias("_entry"))
    return entries.select(*keep, *[F.try_variant_get("_entry", at, kind).alias(n) for n, (at, kind) in values.items()])


def append_report(
    report: DataFrame, namespace: str = "profiles", name: str = "quality_reports", path: str | None = None
) -> None:
    report.sparkSession.sql(f"CREATE NAMESPACE IF NOT EXISTS `{namespace}`")
    writer = report.write.mode("append")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(f"`{namespace}`.`{name}`")
