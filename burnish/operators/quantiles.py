"""Exact quantiles without gathering a column in one task.

Spark's ``percentile`` and ``median`` are exact but hold every distinct value of a
group in one buffer.  Here a mergeable sketch first brackets the wanted rank; only
values inside the bracket are then counted, and a wide bracket is narrowed again.
The answer never rests on the sketch: rows below the bracket are counted exactly and
a bracket that misses the rank is widened to the whole column.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnish.operators.skew import attach
from burnish.session import materialise

ACCURACY = 10_000
# Values of one bracket that may meet in the final ordered pass.
BRACKET_ROWS = 2_000_000


@dataclass(frozen=True)
class Quantile:
    """``q``-quantile of ``value`` over rows where ``where`` holds (SQL expressions)."""

    name: str
    value: str
    q: float = 0.5
    where: str | None = None

    def column(self) -> Column:
        value = F.expr(self.value).cast("double")
        return value if self.where is None else F.when(F.expr(self.where), value)


def _fractions(position: float, rows: int, slack: float) -> list[float]:
    centre = position / max(rows - 1, 1)
    return [max(0.0, centre - slack), min(1.0, centre + slack)]


def exact_quantiles(df: DataFrame, requests: list[Quantile]) -> dict[str, float | None]:
    """Linear-interpolation quantiles of many columns in two passes (more only if large)."""
    if not requests:
        return {}
    # The sketch errs by at most 1 / ACCURACY of the rows; brackets allow twice that.
    slack = 2.0 / ACCURACY
    values = df.select(*[r.column().alias(f"v{i}") for i, r in enumerate(requests)])
    first = values.agg(
        *[F.count(f"v{i}").alias(f"n{i}") for i in range(len(requests))],
        *[
            F.percentile_approx(f"v{i}", _fractions(r.q, 2, slack), F.lit(ACCURACY)).alias(f"b{i}")
            for i, r in enumerate(requests)
        ],
    ).first()
    out: dict[str, float | None] = {}
    live: dict[int, dict] = {}
    for i, r in enumerate(requests):
        rows = first[f"n{i}"]
        if rows == 0:
            out[r.name] = None
            continue
        lo, hi = first[f"b{i}"]
        live[i] = {
            "rows": rows,
            "position": r.q * (rows - 1),
            # A bracket reaching an end of the column is open there.
            "lo": -math.inf if r.q <= slack else lo,
            "hi": math.inf if r.q >= 1 - slack else hi,
            "slack": slack,
            "expected": rows * 2 * slack,
        }
    while live:
        _narrow(values, live)
        picks = _pick(values, live)
        missed = {}
        for i, state in live.items():
            if i not in picks:
                # Start over from the whole column with a bracket eight times as wide.
                missed[i] = {
                    **state, "lo": -math.inf, "hi": math.inf, "slack": state["slack"] * 8, "expected": state["rows"]
                }
                continue
            low, high = picks[i]
            part = state["position"] - math.floor(state["position"])
            out[requests[i].name] = low if part == 0 else low * (1 - part) + high * part
        live = missed
    return out


def _narrow(values: DataFrame, live: dict[int, dict]) -> None:
    """Shrink brackets that still expect too many rows, a few numbers per pass."""
    while True:
        wide = {i: s for i, s in live.items() if s["expected"] > BRACKET_ROWS and s["lo"] < s["hi"]}
        if not wide:
            return
        inside = {
            i: F.when((F.col(f"v{i}") >= F.lit(s["lo"])) & (F.col(f"v{i}") <= F.lit(s["hi"])), F.col(f"v{i}"))
            for i, s in wide.items()
        }
        counted = values.agg(
            *[F.count_if(F.col(f"v{i}") < F.lit(s["lo"])).alias(f"u{i}") for i, s in wide.items()],
            *[F.count(inside[i]).alias(f"n{i}") for i in wide],
        ).first()
        aggs = []
        for i, s in wide.items():
            rows = counted[f"n{i}"]
            local = min(max(s["position"] - counted[f"u{i}"], 0.0), max(rows - 1, 0))
            aggs.append(
                F.percentile_approx(inside[i], _fractions(local, rows, s["slack"]), F.lit(ACCURACY)).alias(f"b{i}")
            )
        bounds = values.agg(*aggs).first()
        for i, s in wide.items():
            lo, hi = bounds[f"b{i}"] or (s["lo"], s["hi"])
            # A bracket that stops shrinking is made of heavy ties: few distinct values.
            stuck = (lo, hi) == (s["lo"], s["hi"])
            s.update(lo=lo, hi=hi, expected=0 if stuck else counted[f"n{i}"] * 2 * s["slack"])


def _pick(values: DataFrame, live: dict[int, dict]) -> dict[int, tuple[float, float]]:
    """Values at the two ranks around each position; absent when the bracket missed."""
    cells, wanted = [], []
    for i, s in live.items():
        v = F.col(f"v{i}")
        # Rows below the bracket collapse into one NULL-valued counter per task.
        cells.append(
            F.when(
                v.isNotNull() & (v <= F.lit(s["hi"])),
                F.struct(F.lit(i).alias("i"), F.when(v >= F.lit(s["lo"]), v).alias("v")),
            )
        )
        at = math.floor(s["position"])
        wanted += [F.when(F.col("i") == i, F.array(F.lit(at), F.lit(min(at + 1, s["rows"] - 1))))]
    histogram = (
        values.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
        .groupBy("c.i", "c.v")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ordered = Window.partitionBy("i").orderBy(F.col("v").asc_nulls_first())
    upto = F.sum("n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = histogram.select("i", "v", (upto - F.col("n")).alias("start"), upto.alias("stop"))
    ranks = F.coalesce(*wanted)
    hits = ranked.select(
        "i",
        "v",
        ((ranks[0] >= F.col("start")) & (ranks[0] < F.col("stop"))).alias("is_low"),
        ((ranks[1] >= F.col("start")) & (ranks[1] < F.col("stop"))).alias("is_high"),
    ).filter("v IS NOT NULL AND (is_low OR is_high)")
    found: dict[int, dict[str, float]] = {}
    for row in hits.collect():  # at most two rows per requested quantile
        slot = found.setdefault(row["i"], {})
        if row["is_low"]:
            slot["low"] = row["v"]
        if row["is_high"]:
            slot["high"] = row["v"]
    return {i: (s["low"], s["high"]) for i, s in found.items() if len(s) == 2}


# Parts a group's bracket is cut into when too many of its values fall inside.
PARTS = 1_024


def grouped_median(df: DataFrame, by: list[str], value: str, name: str, slack: float | None = None) -> DataFrame:
    """Exact median of ``value`` per group: (by…, name), for any number of groups.

    The bracket of each group comes from a sketch aggregated map-side.  If a group is so
    large that its bracket holds more than ``BRACKET_ROWS`` values, the brackets are cut
    into ``PARTS`` equal ranges, counted map-side, and only the ranges that hold the middle
    ranks are ordered.  A group whose bracket missed a rank is redone with a wider one.
    """
    slack = 5.0 / ACCURACY if slack is None else slack
    # NULL group members take part like any other: compare on a null-free copy.
    names = [f"_g{i}" for i in range(len(by))]
    keyed = df.filter(F.col(f"`{value}`").isNotNull()).select(
        *[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")).alias(g) for c, g in zip(by, names)],
        *[F.col(f"`{c}`") for c in by],
        F.col(f"`{value}`").cast("double").alias("_v"),
    )
    low_share, high_share = max(0.0, 0.5 - slack), min(1.0, 0.5 + slack)
    brackets = keyed.groupBy(*names).agg(
        F.count(F.lit(1)).alias("_rows"),
        F.percentile_approx("_v", [low_share, high_share], F.lit(ACCURACY)).alias("_b"),
    )
    low, high = F.floor((F.col("_rows") - 1) / 2), F.ceil((F.col("_rows") - 1) / 2)
    if low_share == 0.0:  # nothing left to miss
        brackets = brackets.withColumn("_b", F.array(F.lit(-math.inf), F.lit(math.inf)))
    brackets = materialise(brackets.select(*names, "_rows", F.col("_b")[0].alias("_lo"), F.col("_b")[1].alias("_hi")), "brackets")
    most = brackets.agg(F.max("_rows")).first()[0] or 0
    if most * 2 * slack > BRACKET_ROWS and low_share > 0.0:
        brackets = _cut(keyed, brackets, names, low, high)
    joined = attach(keyed, brackets, names).filter(F.col("_v") <= F.col("_hi"))
    histogram = joined.groupBy(*names, "_rows", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.first(F.col(f"`{c}`")).alias(c) for c in by]
    )
    ordered = Window.partitionBy(*names).orderBy(F.col("_v").asc_nulls_first())
    upto = F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ranked = histogram.withColumn("_stop", upto).withColumn("_start", F.col("_stop") - F.col("_n"))
    weight = F.when((low >= F.col("_start")) & (low < F.col("_stop")), 1).otherwise(0) + F.when(
        (high >= F.col("_start")) & (high < F.col("_stop")), 1
    ).otherwise(0)
    found = (
        ranked.withColumn("_w", weight)
        .filter((F.col("_w") > 0) & F.col("_v").isNotNull())
        .groupBy(*names)
        .agg(
            *[F.first(F.col(f"`{c}`")).alias(c) for c in by],
            F.sum("_w").alias("_found"),
            (F.sum(F.col("_v") * F.col("_w")) / F.sum("_w")).alias(name),
        )
    )
    found = materialise(found.filter("_found = 2"), "medians")
    done = found.select(*[F.col(f"`{c}`") for c in by], name)
    missed = brackets.join(found, names, "left_anti").select(*names)
    if low_share == 0.0 or missed.isEmpty():
        return done
    texts = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\u0000")).alias(g) for c, g in zip(by, names)]
    again = df.select("*", *texts).join(missed, names, "left_semi").select(*df.columns)
    return done.unionByName(grouped_median(again, by, value, name, slack * 8))


def _cut(keyed: DataFrame, brackets: DataFrame, names: list[str], low: Column, high: Column) -> DataFrame:
    """Brackets shrunk to the equal ranges that hold the two middle ranks."""
    wide = F.col("_hi") - F.col("_lo")
    part = F.when(F.col("_v") < F.col("_lo"), -1).when(wide <= 0, 0).otherwise(
        F.least(F.floor((F.col("_v") - F.col("_lo")) / wide * PARTS), F.lit(PARTS - 1))
    )
    inside = attach(keyed, brackets, names).filter(F.col("_v") <= F.col("_hi"))
    counted = inside.groupBy(*names, "_rows", part.cast("int").alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_least"), F.max("_v").alias("_most")
    )
    by = Window.partitionBy(*names).orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumn("_stop", F.sum("_n").over(by)).filter("_p >= 0")
    start = F.col("_stop") - F.col("_n")
    holds = ((low >= start) & (low < F.col("_stop"))) | ((high >= start) & (high < F.col("_stop")))
    shrunk = ranked.filter(holds).groupBy(*names).agg(F.min("_least").alias("_lo2"), F.max("_most").alias("_hi2"))
    return materialise(
        brackets.join(shrunk, names, "left").select(
            *names, "_rows", F.coalesce("_lo2", "_lo").alias("_lo"), F.coalesce("_hi2", "_hi").alias("_hi")
        ),
        "brackets",
    )
