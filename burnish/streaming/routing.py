"""Late, impossible and drifting rows go to a quarantine sink, with the reason and the watermark."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from burnish.functions.numbers import as_of_literal, holds

SINKS = ("ok", "quarantine")
PROGRESS = "batch_id bigint, rows bigint, ok bigint, late bigint, impossible bigint, clock_drift bigint, no_time bigint, latest timestamp_ntz, watermark timestamp_ntz"


def route(event: str, ingest: str | None, as_of: str | None, watermark: Column | None = None) -> Column:
    """Reason a row is kept out, or ``ok``: read before it happened, from the future, without time, or late."""
    moment = F.col(event)
    out = F.when(moment.isNull(), F.lit("no_time"))
    if ingest is not None:
        out = out.when(holds(F.col(ingest) < moment), F.lit("impossible"))
    out = out.when(holds(moment > as_of_literal(as_of)), F.lit("clock_drift"))
    if watermark is not None:
        out = out.when(holds(moment < watermark), F.lit("late"))
    return out.otherwise(F.lit("ok"))


def route_to_sinks(path: str, event: str, ingest: str | None, delay: str, as_of: str | None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: each row lands in exactly one sink.

    The watermark of a batch is the latest event time of all earlier batches less ``delay`` (a
    Spark SQL interval), as in Spark's own watermarks, and only rows that are neither impossible
    nor from the future move it, so a drifting clock cannot make honest rows late.  Rows are
    written once, divided by sink; counts and the latest time are observed during that write and
    stored as the batch's progress.  A batch reads the progress of the one before it; a repeated
    batch overwrites its folders and so comes out the same.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = progress(spark, path, batch_id - 1).first() if batch_id else None
        latest = None if before is None else before["latest"]
        watermark = F.lit(latest).cast("timestamp_ntz") - F.expr(f"INTERVAL {delay}")
        marked = batch.withColumn("route", route(event, ingest, as_of, watermark)).withColumn("watermark", watermark)
        marked = marked.withColumn("sink", F.when(F.col("route") == "ok", F.lit(SINKS[0])).otherwise(F.lit(SINKS[1])))
        sound = F.col("route").isin("ok", "late")
        seen = Observation(f"route-{batch_id}")
        counts = [F.count_if(F.col("route") == r).alias(r) for r in ("ok", "late", "impossible", "clock_drift", "no_time")]
        # The moment travels as a whole number: observed values come to the driver without a zone.
        newest = F.max(F.when(sound, F.unix_micros(F.col(event).cast("timestamp_ltz")))).alias("latest")
        observed = marked.observe(seen, F.count(F.lit(1)).alias("rows"), *counts, newest)
        observed.write.mode("overwrite").partitionBy("sink").parquet(f"{path}/rows/batch_id={batch_id}")
        got = seen.get
        row = spark.range(1).select(
            F.lit(batch_id).cast("bigint").alias("batch_id"),
            *[F.lit(got[c]).cast("bigint").alias(c) for c in ("rows", "ok", "late", "impossible", "clock_drift", "no_time")],
            F.greatest(F.timestamp_micros(F.lit(got["latest"]).cast("bigint")).cast("timestamp_ntz"), F.lit(latest).cast("timestamp_ntz")).alias("latest"),
            watermark.alias("watermark"),
        )
        row.write.mode("overwrite").parquet(f"{path}/progress/{batch_id}")

    return handle


def progress(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    return spark.read.schema(PROGRESS).parquet(f"{path}/progress/{batch_id}")


def all_progress(spark: SparkSession, path: str, batches: int) -> DataFrame:
    """Counts per route, latest event time and watermark of the first ``batches`` batches."""
    return spark.read.schema(PROGRESS).parquet(*[f"{path}/progress/{i}" for i in range(batches)])


def sink(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of one sink; quarantined ones come with ``route`` and the ``watermark`` they met."""
    return spark.read.parquet(f"{path}/rows").filter(F.col("sink") == name).drop("sink")
