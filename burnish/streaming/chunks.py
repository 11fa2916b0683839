"""Cleaning in batches with the whole rule list.

Deletions by key work over all batches (``KeyHistory``), row rules as they come, foreign keys
against the given masters.  Whole-table statistics are kept as counts of values per batch, which
add up exactly.  Rules that cannot be final before the last batch is in (statistics that were
not given, masters that are the table itself, group balances) are refused unless the caller
settles at the end; ``settle`` then gives what one run over all rows gives.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from burnish.functions.numbers import holds
from burnish.operators.counted import counted_stat, merge_counts, value_counts
from burnish.operators.dedupe import dedupe_first
from burnish.plans.domains import Domain
from burnish.plans.engine import Cleaned, clean
from burnish.plans.rules import Balance, Reference, Rule, Stat
from burnish.session import materialise
from burnish.streaming.history import KeyHistory
from burnish.streaming.incremental import unseen

AUDIT = "batch_id bigint, position int, rule string, rows_matched bigint, rows_deleted bigint"


class ChunkedClean:
    """A ``foreachBatch`` handler that cleans batch by batch into folders below ``path``.

    ``rows/batch_id=n`` holds the rows that survive the deletions, ``cleaned/batch_id=n`` the
    cleaned ones, ``audit/n`` what each deleting rule did, ``stats/i/n`` the counted values of
    statistic i.  A repeated batch overwrites its own folders.  Without ``settles``, the rules
    must be final in each batch; with it, ``cleaned`` is provisional (statistics so far, no
    marks that need all rows) and ``settle`` is final.
    """

    def __init__(
        self,
        path: str,
        rules: list[Rule],
        order_by: list[str],
        references: list[Reference] = (),
        masters: dict[str, DataFrame] | None = None,
        balances: list[Balance] = (),
        stats: dict | None = None,
        settles: bool = False,
    ):
        self.path, self.rules, self.order_by = path, list(rules), list(order_by)
        self.references, self.masters, self.balances, self.given = list(references), masters, list(balances), stats
        missing = [r.master for r in self.references if r.master != "self" and r.master not in (masters or {})]
        if missing:
            raise ValueError(f"no master given: {', '.join(missing)}")
        wanted = {s.name: s for r in self.rules for s in r.stats}
        self.stats: list[Stat] = [] if stats is not None else list(wanted.values())
        self.late = [r.mark for r in self.references if r.master == "self"] + [b.mark for b in self.balances]
        waiting = [r.name for r in self.rules if (r.stats and stats is None) or self._marked(r)]
        if waiting and not settles:
            raise ValueError(f"rules that are not final before the last batch: {', '.join(waiting)}")
        self.missing = [r for r in self.rules if r.stage == "key" and r.action != "DELETE_DUPLICATES"]
        self.copies = [r for r in self.rules if r.stage == "key" and r.action == "DELETE_DUPLICATES"]
        self.impossible = [r for r in self.rules if r.stage == "impossible"]
        self.histories = [KeyHistory(f"{path}/keys/{i}", list(r.keys)) for i, r in enumerate(self.copies)]

    @classmethod
    def of(cls, path: str, domain: Domain, columns: list[str], masters: dict[str, DataFrame] | None = None, **options) -> ChunkedClean:
        """The rule list of a domain, for a table with these columns."""
        rules = [r for r in domain.rules if r.column in columns or r.stage in ("key", "impossible")]
        return cls(path, rules, list(domain.order_by), domain.references, masters, domain.balances, **options)

    def _marked(self, rule: Rule) -> bool:
        """True when the rule reads a mark that needs all rows."""
        return any(mark in (rule.when or "") or mark in (rule.value or "") for mark in self.late)

    def _entry(self, rule: Rule, matched, deleted) -> tuple:
        return (self.rules.index(rule), rule.name, matched, deleted)

    def _filtered(self, rows: DataFrame, rules: list[Rule], audit: list) -> DataFrame:
        """Rows that no rule of the group matches; a row is deleted by the first that does."""
        if not rules:
            return rows
        hits = [holds(F.expr(r.when)) for r in rules]
        before = [reduce(lambda a, b: a | b, hits[:i], F.lit(False)) for i in range(len(rules))]
        counts = rows.agg(*[F.count_if(h).alias(f"m{i}") for i, h in enumerate(hits)], *[F.count_if(h & ~b).alias(f"d{i}") for i, (h, b) in enumerate(zip(hits, before))]).first()
        audit += [self._entry(r, counts[f"m{i}"], counts[f"d{i}"]) for i, r in enumerate(rules)]
        return rows.filter(~reduce(lambda a, b: a | b, hits))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, audit = batch.sparkSession, []
        rows = self._filtered(batch, self.missing, audit)
        for rule, history in zip(self.copies, self.histories):
            # The rows kept at this step are the history, also those a later rule deletes.
            fresh = materialise(unseen(dedupe_first(rows, list(rule.keys), self.order_by), rows, history, batch_id), "fresh")
            history.add(batch_id, fresh)
            gone = rows.count() - fresh.count()
            audit.append(self._entry(rule, gone, gone))
            rows = fresh
        rows = self._filtered(rows, self.impossible, audit)
        rows.write.mode("overwrite").parquet(f"{self.path}/rows/batch_id={batch_id}")
        stored = spark.read.schema(batch.schema).parquet(f"{self.path}/rows/batch_id={batch_id}")
        for i, stat in enumerate(self.stats):
            value_counts(stored, stat).write.mode("overwrite").parquet(f"{self.path}/stats/{i}/{batch_id}")
        entries = spark.createDataFrame([(batch_id, *e) for e in audit], AUDIT).coalesce(1)
        entries.write.mode("overwrite").parquet(f"{self.path}/audit/{batch_id}")
        now = [r for r in self._others() if not self._marked(r)]
        known = [r for r in self.references if r.master != "self"]
        done = clean(stored, now, self.order_by, known, self.masters, [], stats=self.stats_upto(spark, batch_id), slim_copy=False)
        done.frame.write.mode("overwrite").parquet(f"{self.path}/cleaned/batch_id={batch_id}")

    def _others(self) -> list[Rule]:
        return [r for r in self.rules if not r.deletes]

    def stats_upto(self, spark: SparkSession, batch_id: int) -> dict:
        """The statistics over all rows up to a batch: the counts of its batches added up."""
        if self.given is not None:
            return self.given
        out = {}
        for i, stat in enumerate(self.stats):
            parts = spark.read.parquet(*[f"{self.path}/stats/{i}/{n}" for n in range(batch_id + 1)])
            out[stat.name] = counted_stat(merge_counts(parts), stat)
        return out

    def audit(self, spark: SparkSession, batches: int) -> DataFrame:
        """What each deleting rule did over all batches."""
        parts = spark.read.schema(AUDIT).parquet(*[f"{self.path}/audit/{n}" for n in range(batches)])
        return parts.groupBy("position", "rule").agg(F.sum("rows_matched").alias("rows_matched"), F.sum("rows_deleted").alias("rows_deleted"))

    def settle(self, spark: SparkSession, batches: int) -> Cleaned:
        """All rules over all survivors, with the merged statistics: equal to one run over all rows."""
        rows = spark.read.parquet(f"{self.path}/rows").drop("batch_id")
        return clean(rows, self._others(), self.order_by, self.references, self.masters, self.balances, stats=self.stats_upto(spark, batches - 1))
