"""Correlations of all column pairs in one pass.

Each task reads its rows once, in Arrow batches, and keeps for every pair of columns the
number of rows where both are present, their means there and their centred sums of squares
and products; five matrices of columns x columns, whatever the number of rows.  One row per
task and pair then travels, and merging corrects the sums for the distance of the task's
means from the overall ones, so large offsets do not cancel digits.

NaN counts as missing, as it does on loading.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnish.session import materialise

_ROWS = "a int, b int, n double, ma double, mb double, caa double, cbb double, cab double"


def _matrices(names: list[str]):
    """The worker's function: Arrow batches of double columns to one row per pair."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        k = len(names)
        n = ma = caa = cab = None
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in names]).astype("float64")
            here = ~np.isnan(x)
            m = here.astype("float64")
            centre = np.where(here, x, 0).sum(0) / np.maximum(here.sum(0), 1)
            x = np.where(here, x - centre, 0)
            bn = m.T @ m
            safe = np.maximum(bn, 1)
            sa, saa, sab = x.T @ m, (x * x).T @ m, x.T @ x
            # Of the first column of a pair; the second's are the transposes.
            bma = sa / safe + np.where(bn > 0, centre[:, None], 0)
            bcaa, bcab = saa - sa * sa / safe, sab - sa * sa.T / safe
            if n is None:
                n, ma, caa, cab = bn, bma, bcaa, bcab
                continue
            both = np.maximum(n + bn, 1)
            da = np.where((n > 0) & (bn > 0), bma - ma, 0)
            weight = n * bn / both
            caa, cab = caa + bcaa + da * da * weight, cab + bcab + da * da.T * weight
            ma = (ma * n + bma * bn) / both
            n = n + bn
        if n is not None:
            i, j = np.triu_indices(k, 1)
            columns = [i.astype("int32"), j.astype("int32"), n[i, j], ma[i, j], ma[j, i], caa[i, j], caa[j, i], cab[i, j]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "n", "ma", "mb", "caa", "cbb", "cab"])

    return run


def correlation_matrix(df: DataFrame, cols: list[str]) -> DataFrame:
    """(column_a, column_b, rows, r) for all pairs in the order of ``cols``; r is NULL where a column is constant."""
    names = [f"c{i}" for i in range(len(cols))]
    numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for c, n in zip(cols, names)])
    parts = materialise(numbers.mapInArrow(_matrices(names), _ROWS), "gram").filter("n > 0")
    overall = parts.groupBy("a", "b").agg(F.sum("n").alias("total"), (F.sum(F.col("n") * F.col("ma")) / F.sum("n")).alias("xa"), (F.sum(F.col("n") * F.col("mb")) / F.sum("n")).alias("xb"))
    off = parts.join(overall, ["a", "b"]).withColumn("da", F.col("ma") - F.col("xa")).withColumn("db", F.col("mb") - F.col("xb"))
    sums = off.groupBy("a", "b").agg(
        F.max("total").cast("bigint").alias("rows"),
        F.sum(F.expr("caa + n * da * da")).alias("saa"),
        F.sum(F.expr("cbb + n * db * db")).alias("sbb"),
        F.sum(F.expr("cab + n * da * db")).alias("sab"),
    )
    named = F.array(*[F.lit(c) for c in cols])
    r = F.when((F.col("saa") > 0) & (F.col("sbb") > 0), F.col("sab") / (F.sqrt("saa") * F.sqrt("sbb")))
    pairs = df.sparkSession.createDataFrame([(i, j) for i in range(len(cols)) for j in range(i + 1, len(cols))], "a int, b int")
    whole = pairs.join(sums, ["a", "b"], "left")
    return whole.select(
        F.element_at(named, F.col("a") + 1).alias("column_a"), F.element_at(named, F.col("b") + 1).alias("column_b"), F.coalesce("rows", F.lit(0)).alias("rows"), r.alias("r")
    )
