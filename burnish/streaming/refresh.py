"""Re-profiling on refresh: profiles merged over batches, and a trigger on observed metrics."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from burnish.operators.sketches import SCHEMA, column_sketches, merge_sketches, sketched_profile

METRICS = "refresh"


def observed(stream: DataFrame, cols: list[str]) -> DataFrame:
    """The stream with the metrics that ``RefreshTrigger`` decides on: rows, and nulls per column."""
    nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"null_{i}") for i, c in enumerate(cols)]
    return stream.observe(METRICS, F.count(F.lit(1)).alias("rows"), *nulls)


@dataclass
class RefreshPolicy:
    """When a profile is stale: enough new rows, or null rates that moved.

    ``growth`` is the share of new rows since the last refresh, ``drift`` the change of a
    column's null share that is worth a new profile.
    """

    cols: list[str]
    growth: float = 0.2
    drift: float = 0.05
    profiled_rows: int = 0
    profiled_nulls: list[int] = field(default_factory=list)
    new_rows: int = 0
    new_nulls: list[int] = field(default_factory=list)

    def add(self, rows: int, nulls: list[int]) -> None:
        self.new_rows += rows
        self.new_nulls = [a + b for a, b in zip(self.new_nulls or [0] * len(nulls), nulls)]

    def reason(self) -> str | None:
        """Why a refresh is due, or None."""
        if not self.new_rows:
            return None
        if not self.profiled_rows:
            return "first"
        if self.new_rows >= self.growth * self.profiled_rows:
            return "growth"
        for name, old, new in zip(self.cols, self.profiled_nulls, self.new_nulls):
            if abs(new / self.new_rows - old / self.profiled_rows) > self.drift:
                return f"drift of {name}"
        return None

    def refreshed(self) -> None:
        """The new rows are part of the profile now."""
        self.profiled_nulls = [a + b for a, b in zip(self.profiled_nulls or [0] * len(self.new_nulls), self.new_nulls)]
        self.profiled_rows += self.new_rows
        self.new_rows, self.new_nulls = 0, []


class RefreshTrigger(StreamingQueryListener):
    """Listens to the observed metrics of a stream and calls ``refresh(reason)`` when its policy says so.

    The listener keeps a few counters and reads no data; what ``refresh`` does (usually
    ``merged_profile`` of what the batches have stored) is the caller's.
    """

    def __init__(self, policy: RefreshPolicy, refresh: Callable[[str], None]):
        self.policy, self.refresh, self.reasons = policy, refresh, []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(METRICS)
        if row is None:
            return
        self.policy.add(row["rows"], [row[f"null_{i}"] for i in range(len(self.policy.cols))])
        reason = self.policy.reason()
        if reason is not None:
            self.policy.refreshed()
            self.reasons.append(reason)
            self.refresh(reason)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def sketch_batches(path: str, cols: list[str] | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` handler: the batch's sketch rows, and the merged ones up to it.

    A batch reads its own rows once and the merged rows of the batch before it; both folders
    are overwritten when it is repeated.
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        column_sketches(batch, cols).write.mode("overwrite").parquet(f"{path}/part/{batch_id}")
        parts = [f"{path}/part/{batch_id}"] + ([f"{path}/merged/{batch_id - 1}"] if batch_id else [])
        merged = merge_sketches(spark.read.schema(SCHEMA).parquet(*parts))
        merged.coalesce(1).write.mode("overwrite").parquet(f"{path}/merged/{batch_id}")

    return handle


def merged_profile(spark: SparkSession, path: str, batch_id: int) -> DataFrame:
    """Profile of everything up to a batch, from its merged sketch rows alone."""
    return sketched_profile(spark.read.schema(SCHEMA).parquet(f"{path}/merged/{batch_id}"))
