"""Incremental forms on Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from burnish.functions.numbers import as_of_literal, holds
from burnish.operators.dedupe import dedupe_first
from burnish.operators.profile import profile_columns
from burnish.operators.skew import is_small
from burnish.plans.domains import Domain
from burnish.plans.engine import clean
from burnish.plans.rules import Check, Rule
from burnish.plans.score import WEIGHTS, score_table
from burnish.session import materialise
from burnish.streaming.history import COMPACT_EVERY, KeyHistory


def file_stream(
    spark: SparkSession, folder: str, schema: T.StructType, pattern: str, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """Files of ``folder`` matching ``pattern`` as a stream."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(folder)


def run_available(stream: DataFrame, path: str, checkpoint: str, partition_by: list[str] = ()) -> StreamingQuery:
    """Append everything now available to Parquet and stop."""
    writer = stream.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    query = writer.option("path", path).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def row_local(rules: list[Rule]) -> list[Rule]:
    """Rules that look at one row only (statistics come stored, not measured)."""
    return [r for r in rules if r.stage not in ("key", "reference")]


def clean_stream(stream: DataFrame, rules: list[Rule], stats: dict) -> DataFrame:
    """Row-local rules on a stream, with statistics of a stored profile.

    A rule that needs other rows raises: choose with ``row_local``, or use
    ``chunks.ChunkedClean``, which applies key and reference rules as well.
    """
    others = [r.name for r in rules if r not in row_local(rules)]
    if others:
        raise ValueError(f"rules that need other rows: {', '.join(others)}")
    return clean(stream, rules, [], stats=stats).frame


def _event_time(df: DataFrame, column: str, delay: str) -> DataFrame:
    """Watermark on ``_event_time``: watermarks need a zoned timestamp, tables may hold none."""
    return df.withColumn("_event_time", F.col(column).cast("timestamp_ltz")).withWatermark("_event_time", delay)


def dedupe_stream(stream: DataFrame, keys: list[str], event_time: str, delay: str) -> DataFrame:
    """First row per key while copies arrive within ``delay``; state is dropped after it."""
    marked = _event_time(stream, event_time, delay)
    return marked.dropDuplicatesWithinWatermark(keys).drop("_event_time")


def dedupe_into(path: str, keys: list[str], order_by: list[str], compact_every: int = COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: keep keys not yet in the target, without state in memory.

    Each batch owns one folder that a repeated batch overwrites, so a restart neither
    loses nor doubles rows.  NULL keys are keys like any other.  Earlier keys are a
    ``KeyHistory`` beside the rows, of which a batch opens only the buckets that may hold its keys.
    """
    history = KeyHistory(f"{path}/_keys", keys, compact_every=compact_every)

    def handle(batch: DataFrame, batch_id: int) -> None:
        fresh = unseen(dedupe_first(batch, keys, order_by), batch, history, batch_id)
        fresh.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        history.add(batch_id, batch.sparkSession.read.schema(batch.select(*keys).schema).parquet(f"{path}/batch_id={batch_id}"))

    return handle


def unseen(fresh: DataFrame, batch: DataFrame, history: KeyHistory, batch_id: int) -> DataFrame:
    """The rows of ``fresh`` whose keys no earlier batch had.

    The batch's keys are measured: within the broadcast limits they are sent to the history,
    which is then not shuffled, and only keys found there come back.
    """
    keys = history.keys
    history.compact(batch_id, batch.schema)
    asked = materialise(batch.select(*keys).distinct(), "keys")
    seen = history.seen(asked, batch_id)
    if seen is None:
        return fresh
    if is_small(asked):
        seen = F.broadcast(seen_before(seen, asked, keys))
    same = reduce(lambda a, b: a & b, [fresh[k].eqNullSafe(seen[n]) for k, n in zip(keys, history.names)])
    return fresh.join(seen, same, "left_anti")


def seen_before(history: DataFrame, asked: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the history that a few keys ask for: the keys travel, the history stays."""
    few = F.broadcast(asked)
    same = reduce(lambda a, b: a & b, [history[f"_k{i}"].eqNullSafe(few[k]) for i, k in enumerate(keys)])
    return history.join(few, same, "left_semi")


def run_batches(stream: DataFrame, handler: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    query = (
        stream.writeStream.foreachBatch(handler)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def route_late(stream: DataFrame, event: str, ingest: str, as_of: str | None) -> DataFrame:
    """Mark each row for its sink: ok, impossible order, or an event in the future."""
    route = (
        F.when(holds(F.col(ingest) < F.col(event)), F.lit("impossible"))
        .when(holds(F.col(event) > as_of_literal(as_of)), F.lit("clock_drift"))
        .otherwise(F.lit("ok"))
    )
    return stream.withColumn("route", route)


def windowed_quality(df: DataFrame, ts: str, width: str, checks: list[Check], delay: str | None = None) -> DataFrame:
    """Passing rows per dimension and tumbling window, on a table or a stream."""
    if delay is not None:
        df, ts = _event_time(df, ts, delay), "_event_time"
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    names = ["total_rows"]
    for dimension in WEIGHTS:
        tests = [c.predicate() for c in checks if c.dimension == dimension and c.column in df.columns]
        if tests:
            fails = tests[0]
            for t in tests[1:]:
                fails = fails | t
            aggs.append(F.count_if(~fails).alias(f"{dimension}_rows"))
            names.append(f"{dimension}_rows")
    return df.groupBy(F.window(ts, width).alias("w")).agg(*aggs).select(
        F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *names
    )


def on_refresh(domain: Domain, path: str, approx: bool = True) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: profile and score each refresh into its own folders."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        profile_columns(batch, approx=approx).write.mode("overwrite").parquet(f"{path}/profile/batch_id={batch_id}")
        score_table(batch, domain).write.mode("overwrite").parquet(f"{path}/score/batch_id={batch_id}")

    return handle
