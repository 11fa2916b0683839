"""Five-dimension quality scores, grades and before/after comparison."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnish.functions.numbers import holds
from burnish.operators.dedupe import key_multiplicity
from burnish.operators.detect import affected_count, issue_counts, issue_rows
from burnish.operators.profile import null_cells
from burnish.plans.domains import Domain
from burnish.plans.engine import mark_imbalances, mark_orphans
from burnish.plans.rules import Check
from burnish.session import materialise

# Weights and grade scales the results are defined by.
WEIGHTS = {"completeness": 0.25, "validity": 0.25, "uniqueness": 0.20, "consistency": 0.20, "accuracy": 0.10}
SCALES = {
    "framework": (("A", 95.0), ("B", 85.0), ("C", 70.0), ("D", 55.0)),
    "lenient": (("A", 90.0), ("B", 75.0), ("C", 60.0), ("D", 45.0)),
    "null_cell": (("A", 90.0), ("B", 80.0), ("C", 70.0), ("D", 60.0)),
}
NULL_CELL_PENALTY = {"orders": 5, "telemetry": 3, "workforce": 4, "ledger": 3, "catalog": 5}


def grade(score: Column, scale: str = "framework") -> Column:
    out = F.when(score.isNull(), F.lit(None).cast("string"))
    for letter, bound in SCALES[scale]:
        out = out.when(score >= bound, F.lit(letter))
    return out.otherwise(F.lit("F"))


def uniqueness(df: DataFrame, keys: list[str], extra_only: bool = False) -> DataFrame:
    """Rows failing because their key occurs more than once, and the score."""
    counted = key_multiplicity(df, keys)
    failing = F.col("extra_copies" if extra_only else "shared_rows")
    return counted.select(
        "total_rows",
        failing.alias("failing_rows"),
        F.try_divide((F.col("total_rows") - failing) * 100, F.col("total_rows")).alias("uniqueness"),
    )


def _passing(df: DataFrame, checks: list[Check]) -> list[Column]:
    """Total rows, and the rows that pass each dimension but uniqueness."""
    aggs = [F.count(F.lit(1)).alias("total_rows")]
    for dimension in WEIGHTS:
        tests = [c.predicate() for c in checks if c.dimension == dimension and c.column in df.columns]
        if dimension != "uniqueness":
            fails = reduce(lambda a, b: a | b, tests) if tests else F.lit(False)
            aggs.append(F.count_if(~fails).alias(f"_{dimension}"))
    return aggs


def _dimensions(counted: DataFrame, unique: Column) -> DataFrame:
    columns = [
        unique.alias(d) if d == "uniqueness" else F.try_divide(F.col(f"_{d}") * 100, F.col("total_rows")).alias(d)
        for d in WEIGHTS
    ]
    return counted.select("total_rows", *columns)


def score_dimensions(
    df: DataFrame, checks: list[Check], keys: list[str], extra_only: bool = False, bare: DataFrame | None = None
) -> DataFrame:
    """One row: total rows and the five dimension scores.

    A row fails a dimension when any of its checks fires; four dimensions share one
    pass, uniqueness counts keys without joining back to the rows.  ``bare`` is the frame
    without marks: keys are counted there, so the joins behind the marks run once.
    """
    unique = uniqueness(df if bare is None else bare, keys, extra_only).select("uniqueness")
    return _dimensions(df.agg(*_passing(df, checks)), unique.scalar())


def overall_score(dims: DataFrame, weights: dict[str, float] | None = None, scale: str = "framework") -> DataFrame:
    weights = weights or WEIGHTS
    total = reduce(lambda a, b: a + b, [F.col(d) * F.lit(w) for d, w in weights.items()])
    scored = dims.withColumn("overall", F.round(total, 4))
    return scored.withColumn("grade", grade(F.col("overall"), scale))


def with_marks(df: DataFrame, domain: Domain, masters: dict[str, DataFrame] | None = None) -> DataFrame:
    """Add the boolean columns that reference and balance checks read."""
    for ref in domain.references:
        master = df if ref.master == "self" else (masters or {})[ref.master]
        df = mark_orphans(df, ref, master)
    read = {c.when for c in domain.checks}
    return mark_imbalances(df, [b for b in domain.balances if b.mark in read])


def score_table(
    df: DataFrame,
    domain: Domain,
    masters: dict[str, DataFrame] | None = None,
    weights: dict[str, float] | None = None,
    scale: str = "framework",
) -> DataFrame:
    marked = with_marks(df, domain, masters)
    return overall_score(score_dimensions(marked, domain.checks, list(domain.key), bare=df), weights, scale)


@dataclass
class Measured:
    """What one pass over a marked layer tells: one score row, issue rows, affected rows."""

    scores: DataFrame
    issues: DataFrame
    affected: DataFrame


def measure_layer(
    df: DataFrame,
    domain: Domain,
    masters: dict[str, DataFrame] | None = None,
    weights: dict[str, float] | None = None,
    scale: str = "framework",
    repeated: DataFrame | None = None,
) -> Measured:
    """Score, issues and affected rows of a layer: marked once, aggregated once, stored as one row.

    ``repeated`` holds the layer's keys that occur more than once, with their rows ``_n``, if they were counted before.
    """
    marked = with_marks(df, domain, masters)
    checks = [c for c in domain.checks if c.column in marked.columns]
    counted = marked.agg(*_passing(marked, checks), *issue_counts(checks), affected_count(checks))
    if repeated is None:
        unique = uniqueness(df, list(domain.key)).select("uniqueness").scalar()
    else:
        shared = repeated.agg(F.coalesce(F.sum("_n"), F.lit(0))).scalar()
        unique = F.try_divide((F.col("total_rows") - shared) * 100, F.col("total_rows"))
    counted = materialise(counted.withColumn("_unique", unique), "measured")
    return Measured(
        overall_score(_dimensions(counted, F.col("_unique")), weights, scale),
        issue_rows(counted, checks),
        counted.select("total_rows", "affected_rows"),
    )


def score_layers(layers: dict[str, DataFrame], table: str) -> DataFrame:
    """Score rows of several layers of one table under one another."""
    pieces = [s.select(F.lit(table).alias("table_name"), F.lit(layer).alias("layer"), "*") for layer, s in layers.items()]
    return reduce(DataFrame.unionByName, pieces)


def dimensions_long(scores: DataFrame) -> DataFrame:
    """(table_name, layer, dimension, score) with the overall score as a dimension."""
    items = [
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("double").alias("score")) for d in [*WEIGHTS, "overall"]
    ]
    return scores.select("table_name", "layer", F.inline(F.array(*items)))


def compare_scores(scores: DataFrame, before: str = "raw", after: str = "cleaned", scale: str = "framework") -> DataFrame:
    """Before, after, gain and grade change per table and dimension."""
    sides = dimensions_long(scores).groupBy("table_name", "dimension").agg(
        F.max(F.when(F.col("layer") == before, F.col("score"))).alias("before_score"),
        F.max(F.when(F.col("layer") == after, F.col("score"))).alias("after_score"),
    )
    return sides.select(
        "table_name",
        "dimension",
        F.round("before_score", 4).alias("before_score"),
        F.round("after_score", 4).alias("after_score"),
        F.round(F.col("after_score") - F.col("before_score"), 4).alias("gain"),
        F.concat(grade(F.col("before_score"), scale), F.lit(" -> "), grade(F.col("after_score"), scale)).alias(
            "grade_change"
        ),
    )


def top_gain(compare: DataFrame) -> DataFrame:
    """Table with the largest gain per dimension (ties share the rank)."""
    rank = F.dense_rank().over(Window.partitionBy("dimension").orderBy(F.desc("gain")))
    return (
        compare.filter("dimension <> 'overall'")
        .withColumn("gain_rank", rank)
        .filter("gain_rank = 1")
        .select("dimension", "table_name", "gain")
    )


def average_scores(compare: DataFrame) -> DataFrame:
    return compare.groupBy("dimension").agg(
        F.round(F.avg("before_score"), 4).alias("avg_before"),
        F.round(F.avg("after_score"), 4).alias("avg_after"),
        F.round(F.avg("gain"), 4).alias("avg_gain"),
    )


def null_cell_score(df: DataFrame, penalty: float) -> DataFrame:
    """100 minus null-cell percentage minus a fixed penalty, with its own grade scale."""
    score = F.round(F.greatest(F.lit(0.0), 100 - F.col("null_pct") - F.lit(float(penalty))), 1)
    return null_cells(df).select(
        "total_cells", "null_cells", score.alias("score"), grade(score, "null_cell").alias("grade")
    )


def _layered(layers: dict[str, DataFrame], predicate: str, name: str, digits: int) -> DataFrame:
    passing = F.count_if(holds(F.expr(predicate)))
    pieces = [
        df.agg(F.count(F.lit(1)).alias("total_rows"), passing.alias("passing_rows")).select(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("check_name"),
            "total_rows",
            "passing_rows",
            F.round(F.try_divide(F.col("passing_rows") * 100, F.col("total_rows")), digits).alias("score"),
        )
        for layer, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, pieces)


def completeness_check(layers: dict[str, DataFrame], cols: list[str]) -> DataFrame:
    return _layered(layers, " AND ".join(f"`{c}` IS NOT NULL" for c in cols), "Completeness", 1)


def validity_check(layers: dict[str, DataFrame], predicate: str, digits: int = 1) -> DataFrame:
    return _layered(layers, predicate, "Validity", digits)


def consistency_check(layers: dict[str, DataFrame], column: str, regex: str) -> DataFrame:
    escaped = regex.replace("\\", "\\\\").replace("'", "\\'")
    return _layered(layers, f"`{column}` RLIKE '{escaped}'", "Consistency", 1)


def count_where(layers: dict[str, DataFrame], predicate: str, name: str = "matching_rows") -> DataFrame:
    pieces = [
        df.agg(F.count_if(holds(F.expr(predicate))).alias(name)).select(F.lit(layer).alias("layer"), name)
        for layer, df in layers.items()
    ]
    return reduce(DataFrame.unionByName, pieces)


def accuracy_check(layers: dict[str, DataFrame], start: str, end: str) -> DataFrame:
    return count_where(layers, f"`{start}` > `{end}`", "impossible_sequences")
