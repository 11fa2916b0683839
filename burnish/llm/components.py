"""Connected components by alternating large and small stars.

Every round is two aggregations and two joins over the edges; the number of rounds grows
with the logarithm of the longest path, also along chains.  Rounds are written to the
shared folder, so a lost executor costs one round and the plan stays short.  A centre with
a third of all edges is one side of a sort-merge join whose other side has one row for it,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from burnish.session import materialise

ROUNDS = 60


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, root): the smallest node reachable; one row per linked node."""
    edges = materialise(edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    mark = _mark(edges)
    for _ in range(ROUNDS):
        if not mark[0]:
            break
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
        large = both.join(low, F.col("a") == F.col("u")).filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), "m")
        small = large.join(least, F.col("a") == F.col("u")).select(F.explode(F.array(F.struct(F.col("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        edges = materialise(small.select("e.*").filter(F.col("a") != F.col("b")).distinct(), "edges")
        now = _mark(edges)
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
