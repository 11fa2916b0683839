"""Rules to one Spark plan: delete, take statistics, then one projection per stage."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from burnish.functions.aggregates import pearson
from burnish.functions.numbers import holds
from burnish.operators.dedupe import dedupe_first, dedupe_rest, duplicate_rows, repeated_keys
from burnish.operators.profile import modes
from burnish.operators.quantiles import Quantile, exact_quantiles
from burnish.operators.skew import attach
from burnish.plans.rules import (
    FUNCTIONS,
    STAGES,
    TESTS,
    Balance,
    Reference,
    Rule,
    Stat,
    fill_stats,
)
from burnish.session import materialise

SPELLED = "_spelled_{}"  # column with the canonical form of another's value, while text rules run

AUDIT_SCHEMA = (
    "position int, action string, column_name string, rule string, "
    "rows_matched bigint, rows_deleted bigint, cells_modified bigint"
)


def build_stages(rules: list[Rule]) -> list[tuple[str, list[Rule]]]:
    """Rules grouped into the fixed stage order; order inside a stage is kept."""
    return [(s, group) for s in STAGES if (group := [r for r in rules if r.stage == s])]


def compute_stats(df: DataFrame, stats: list[Stat]) -> dict:
    """All statistics of a table: quantiles together, plain aggregates together."""
    stats = list({s.name: s for s in stats}.values())
    quantiles = [s for s in stats if s.kind == "quantile"]
    counted = [s for s in stats if s.kind == "mode"]
    plain = [s for s in stats if s.kind not in ("quantile", "mode")]
    out = exact_quantiles(df, [Quantile(s.name, s.value, s.q, s.where) for s in quantiles])
    if plain:
        row = df.agg(*[_aggregate(s).alias(f"a{i}") for i, s in enumerate(plain)]).first()
        out.update({s.name: row[f"a{i}"] for i, s in enumerate(plain)})
    if counted:
        values = df.select(*[_stat_value(s).alias(f"m{i}") for i, s in enumerate(counted)])
        found = modes(values, values.columns)
        out.update({s.name: found[f"m{i}"] for i, s in enumerate(counted)})
    return out


def _mentioned(expressions: list[str | None], columns: list[str]) -> set[str]:
    """Columns whose names occur in the expressions (a few too many do no harm)."""
    words = set(re.findall(r"[A-Za-z_][A-Za-z0-9_]*", " ".join(e for e in expressions if e)))
    return words & set(columns)


def slim_columns(
    columns: list[str], rules: list[Rule], stats: list[Stat], references: list[Reference], balances: list[Balance]
) -> set[str]:
    """Columns that statistics, own-table masters and group sums are computed from."""
    need = _mentioned([e for s in stats for e in (s.value, s.where, s.other)], columns)
    need |= {r.key for r in references if r.master == "self"}
    reach = _mentioned([e for b in balances for e in (b.key, b.a, b.b, b.where)], columns)
    while True:
        # Rules that change a summed column bring the columns they read.
        feeding = [r for r in rules if not r.deletes and r.changes_value and r.column in reach]
        more = reach | _mentioned([e for r in feeding for e in (r.when, r.value)], columns)
        if more == reach:
            return need | reach
        reach = more


def _aggregate(stat: Stat) -> Column:
    makers = {"mean": F.avg, "min": F.min, "max": F.max, "sum": F.sum, "skewness": F.skewness}
    if stat.kind in makers:
        return makers[stat.kind](_stat_value(stat))
    pairs = {"slope": F.regr_slope, "intercept": F.regr_intercept, "corr": pearson}
    return pairs[stat.kind](_stat_value(stat), F.expr(stat.other))


def _stat_value(stat: Stat) -> Column:
    value = F.expr(stat.value)
    return value if stat.where is None else F.when(F.expr(stat.where), value)


def mark_orphans(df: DataFrame, ref: Reference, master: DataFrame) -> DataFrame:
    """Boolean ``ref.mark``: the key is not NULL and not in the master."""
    keys = (
        master.select(F.col(ref.key).alias(ref.column))
        .filter(F.col(ref.column).isNotNull())
        .distinct()
        .withColumn(f"_known_{ref.column}", F.lit(True))
    )
    known = f"_known_{ref.column}"
    return (
        attach(df, keys, [ref.column])
        .withColumn(ref.mark, F.col(ref.column).isNotNull() & F.col(known).isNull())
        .drop(known)
    )


def group_imbalance(df: DataFrame, rule: Balance) -> DataFrame:
    """Groups whose two sums differ: (key, difference)."""
    rows = df if rule.where is None else df.filter(F.expr(rule.where))
    sums = rows.groupBy(rule.key).agg((F.sum(rule.a) - F.sum(rule.b)).alias("difference"))
    return sums.filter(F.abs("difference") > rule.tol)


def mark_imbalances(df: DataFrame, balances: list[Balance], source: DataFrame | None = None) -> DataFrame:
    """Boolean marks on every row (in scope) of an imbalanced group.

    Balances over one key share one aggregation and one join back.  ``source`` is a
    narrower frame with the same rows to sum over.  Imbalanced groups are taken to be few, so
    only rows that may belong to one go through the shuffle of a large lookup.
    """
    for key in dict.fromkeys(b.key for b in balances):
        group = [b for b in balances if b.key == key]
        scopes = [F.lit(True) if b.where is None else holds(F.expr(b.where)) for b in group]
        gaps = [
            (F.abs(F.sum(F.when(s, F.col(b.a))) - F.sum(F.when(s, F.col(b.b)))) > b.tol).alias(f"_off{i}")
            for i, (b, s) in enumerate(zip(group, scopes))
        ]
        off = [F.col(f"_off{i}") for i in range(len(group))]
        sums = (df if source is None else source).groupBy(key).agg(*gaps).filter(reduce(lambda x, y: x | y, [holds(o) for o in off]))
        df = attach(df, sums, [key], few=True).withColumns(
            {b.mark: holds(o) & s for b, o, s in zip(group, off, scopes)}
        ).drop(*[f"_off{i}" for i in range(len(group))])
    return df


@dataclass
class Cleaned:
    """Result of ``clean``: the table, what was measured, and frames for the audit."""

    frame: DataFrame
    raw: DataFrame
    steps: list[Deletion]
    survivors: DataFrame
    marked: DataFrame
    rules: list[Rule]
    stats: dict
    order_by: list[str]
    observed: dict | None = None

    def store(self, name: str) -> DataFrame:
        """Write the cleaned table once, counting the audit's hits in the same job."""
        counts = _rule_counts(self)
        if not counts:
            return materialise(self.frame, name)
        seen = Observation(f"audit-{name}")
        stored = materialise(self.marked.observe(seen, *counts).select(*self.frame.columns), name)
        self.observed = seen.get
        return stored

    def repeated(self, keys: tuple[str, ...]) -> DataFrame | None:
        """Keys of the raw table that have copies, with their rows ``_n``, if a rule over ``keys`` counted them there."""
        first = self.steps[0] if self.steps else None
        return first.repeated if first is not None and first.by_key and first.rules[0].keys == keys else None

    def audit(self) -> DataFrame:
        """One row per rule: matched, deleted, cells really changed."""
        return audit_frame(self)

    def totals(self) -> DataFrame:
        return audit_totals(self.audit())

    def removed_rows(self) -> DataFrame:
        return removed_rows(self)


@dataclass
class Deletion:
    """One deletion step: the rows it saw and the rules that applied to them."""

    before: DataFrame
    rules: list[Rule]
    by_key: bool
    repeated: DataFrame | None = None  # stored keys with more than one row, if they were counted


def surviving_rows(df: DataFrame, rules: list[Rule], order_by: list[str], store: bool = False) -> tuple[list[Deletion], DataFrame]:
    """Deletion steps and what is left: rows without a key, extra copies, impossible rows.

    ``store`` counts rows per key first and writes the keys with copies and their first rows, so that
    rows without a copy are not shuffled, and whatever reads the result later shuffles nothing again.
    """
    missing = [r for r in rules if r.stage == "key" and r.action != "DELETE_DUPLICATES"]
    copies = [r for r in rules if r.stage == "key" and r.action == "DELETE_DUPLICATES"]
    impossible = [r for r in rules if r.stage == "impossible"]
    steps = []
    for group in [missing, *[[r] for r in copies], impossible]:
        if not group:
            continue
        by_key = group[0].action == "DELETE_DUPLICATES"
        keys = list(group[0].keys)
        repeated = repeated_keys(df, keys) if by_key and store else None
        steps.append(Deletion(df, group, by_key, repeated))
        if by_key:
            df = dedupe_first(df, keys, order_by) if repeated is None else dedupe_rest(df, keys, order_by, repeated)
        else:
            gone = reduce(lambda a, b: a | b, [holds(F.expr(r.when)) for r in group])
            df = df.filter(~gone)
    return steps, df


def clean(
    df: DataFrame,
    rules: list[Rule],
    order_by: list[str],
    references: list[Reference] = (),
    masters: dict[str, DataFrame] | None = None,
    balances: list[Balance] = (),
    mode: str = "clean",
    stats: dict | None = None,
    slim_copy: bool = True,
    spellings: dict[str, DataFrame] | None = None,
) -> Cleaned:
    """Apply rules in stage order.

    ``mode="flag_only"`` writes flags and changes nothing else.  ``stats`` skips the
    statistics passes (incremental runs use the stored ones).  A master named "self"
    is the table's own surviving rows.

    Statistics, own-table masters and group sums read few columns, but each needs the
    surviving rows.  If a rule deletes copies, the keys that have some and their first rows are
    stored once, and statistics and result read these and the other rows of ``df``; without such a
    rule only the columns needed are stored (``slim_copy``).

    ``spellings`` holds a dictionary per column, (column, canonical); it is joined before the
    text rules, which find a value's canonical form (NULL if it has none) in ``SPELLED``.
    """
    flag_only = mode == "flag_only"
    wanted = [] if stats is not None else [s for r in rules for s in r.stats]
    columns = slim_columns(df.columns, rules, wanted, references, balances)
    steps, survivors = ([], df) if flag_only else surviving_rows(df, rules, order_by, store=slim_copy)
    slim = survivors
    if slim_copy and columns and not any(s.by_key for s in steps):
        slim = materialise(survivors.select(*[c for c in df.columns if c in columns]), "slim")
    if stats is None:
        stats = compute_stats(slim, wanted)

    def staged(frame: DataFrame, group: list[Rule]) -> DataFrame:
        return frame.withColumns(_projection(frame, group, stats, positions, flag_only))

    def spelled(frame: DataFrame) -> DataFrame:
        for c, lookup in (spellings or {}).items():
            if c in frame.columns:
                frame = attach(frame, lookup.select(c, F.col("canonical").alias(SPELLED.format(c))), [c])
        return frame

    frame, narrow = survivors, slim
    positions = {id(r): i for i, r in enumerate(rules)}
    for stage, group in build_stages(rules):
        if stage in ("key", "impossible"):
            continue
        if stage == "reference":
            for ref in references:
                master = slim if ref.master == "self" else (masters or {})[ref.master]
                frame = mark_orphans(frame, ref, master)
            frame = mark_imbalances(frame, list(balances), narrow)
        if stage == "text":
            frame = spelled(frame)
            narrow = spelled(narrow) if slim is not survivors else frame
        if stage != "reference" and slim is not survivors:
            own = [r for r in group if r.changes_value and _readable(r, df.columns, narrow.columns)]
            narrow = staged(narrow, own) if own else narrow
        frame = staged(frame, group)
        if slim is survivors:
            narrow = frame
    marks = [r.mark for r in references] + [b.mark for b in balances] + [SPELLED.format(c) for c in spellings or {}]
    marked = frame.drop(*marks)
    markers = [c for c in marked.columns if c.startswith(("_hit_", "_set_"))]
    return Cleaned(marked.drop(*markers), df, steps, survivors, marked, rules, stats, order_by)


def _readable(rule: Rule, columns: list[str], present: list[str]) -> bool:
    """True when every table column the rule touches is in the narrow frame."""
    return _mentioned([rule.column, rule.when, rule.value], columns) <= set(present)


def _projection(frame, group, stats, positions, flag_only) -> dict[str, Column]:
    """Column updates of one stage; all conditions read the stage's input."""
    updates: dict[str, Column] = {}
    markers: dict[str, Column] = {}
    types = {f.name: f.dataType for f in frame.schema.fields}
    for rule in group:
        i = positions[id(rule)]
        hit = holds(F.expr(fill_stats(rule.when, stats))) if rule.when else None
        if rule.test:
            hit = holds(TESTS[rule.test](F.col(rule.column), **rule.args))
        if rule.flag:
            before = updates.get(rule.flag, F.col(rule.flag) if rule.flag in types else F.lit(None))
            updates[rule.flag] = F.coalesce(before, F.when(hit, F.lit(rule.label))).cast("string")
        if rule.changes_value and not flag_only:
            old = F.col(rule.column)
            if rule.value is not None:
                new = F.expr(fill_stats(rule.value, stats))
            else:
                new = FUNCTIONS[rule.fn](old, **rule.args)
            new = new.cast(types[rule.column])
            changed = ~old.eqNullSafe(new) if hit is None else hit & ~old.eqNullSafe(new)
            before = updates.get(rule.column, old)
            updates[rule.column] = new if hit is None else F.when(hit, new).otherwise(before)
            markers[f"_set_{i}"] = changed
            hit = changed if hit is None else hit
        markers[f"_hit_{i}"] = F.lit(False) if hit is None else hit
    return {**updates, **markers}


def _row_rules(result: Cleaned) -> list[tuple[int, Rule]]:
    return [(i, r) for i, r in enumerate(result.rules) if not r.deletes]


def _rule_counts(result: Cleaned) -> list[Column]:
    """Matched rows and changed cells of every rule that looks at one row."""
    present = set(result.marked.columns)
    counts = []
    for i, _ in _row_rules(result):
        counts.append(F.count_if(f"_hit_{i}").alias(f"h{i}"))
        if f"_set_{i}" in present:
            counts.append(F.count_if(f"_set_{i}").alias(f"c{i}"))
    return counts


def audit_frame(result: Cleaned) -> DataFrame:
    """Three aggregations: copies per key, deletions, and every other rule at once."""
    spark = result.raw.sparkSession
    pieces = []

    def rows(one_row: DataFrame, entries: list[tuple]) -> DataFrame:
        items = [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(r.action).alias("action"),
                F.lit(r.column).alias("column_name"),
                F.lit(r.name).alias("rule"),
                hit.alias("rows_matched"),
                gone.alias("rows_deleted"),
                changed.alias("cells_modified"),
            )
            for i, r, hit, gone, changed in entries
        ]
        return one_row.select(F.inline(F.array(*items)))

    zero = F.lit(0).cast("bigint")
    for step in result.steps:
        if step.by_key:
            (rule,) = step.rules
            counted = step.repeated
            if counted is None:
                counted = step.before.groupBy(*rule.keys).agg(F.count(F.lit(1)).alias("_n"))
            copies = counted.agg(F.coalesce(F.sum(F.col("_n") - 1), zero).alias("copies"))
            entry = (result.rules.index(rule), rule, F.col("copies"), F.col("copies"), zero)
            pieces.append(rows(copies, [entry]))
            continue
        aggs, earlier = [], F.lit(False)
        for n, rule in enumerate(step.rules):
            hit = holds(F.expr(rule.when))
            aggs += [F.count_if(hit).alias(f"h{n}"), F.count_if(hit & ~earlier).alias(f"d{n}")]
            earlier = earlier | hit
        entries = [
            (result.rules.index(r), r, F.col(f"h{n}"), F.col(f"d{n}"), zero) for n, r in enumerate(step.rules)
        ]
        pieces.append(rows(step.before.agg(*aggs), entries))
    others = _row_rules(result)
    if others:
        counts = _rule_counts(result)
        if result.observed is not None:
            counted = spark.range(1).select(
                *[F.lit(value).cast("bigint").alias(name) for name, value in result.observed.items()]
            )
        else:
            counted = result.marked.agg(*counts)
        present = set(result.marked.columns)
        entries = [
            (i, r, F.col(f"h{i}"), zero, F.col(f"c{i}") if f"_set_{i}" in present else zero)
            for i, r in others
        ]
        pieces.append(rows(counted, entries))
    if not pieces:
        return spark.createDataFrame([], AUDIT_SCHEMA)
    return reduce(DataFrame.unionByName, pieces)


def audit_totals(audit: DataFrame) -> DataFrame:
    return audit.agg(
        F.sum("rows_deleted").alias("rows_deleted"), F.sum("cells_modified").alias("rows_modified")
    )


def removed_rows(result: Cleaned) -> DataFrame:
    """Every deleted row with the rule that deleted it."""
    pieces = []
    for step in result.steps:
        if step.by_key:
            (rule,) = step.rules
            extra = duplicate_rows(step.before, list(rule.keys), result.order_by)
            pieces.append(extra.withColumn("reason", F.lit(rule.name)))
        else:
            reason = F.coalesce(*[F.when(holds(F.expr(r.when)), F.lit(r.name)) for r in step.rules])
            pieces.append(step.before.withColumn("reason", reason).filter(F.col("reason").isNotNull()))
    if not pieces:
        return result.raw.withColumn("reason", F.lit("")).filter(F.lit(False))
    return reduce(DataFrame.unionByName, pieces)
