"""The whole preparation: raw tables in, cleaned tables, scores, audit and reports out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.operators.profile import column_ranges, profile_columns, profile_metadata, value_lists
from burnish.plans.decide import decide, measure, recommendations
from burnish.plans.domains import Domain
from burnish.plans.engine import Cleaned, audit_totals
from burnish.plans.score import compare_scores, measure_layer, score_layers
from burnish.session import materialise
from burnish.sources.load import profile_document, report_row


@dataclass
class Prepared:
    """One table's outcome.  ``cleaned`` is a written copy, the rest are small frames."""

    name: str
    result: Cleaned
    cleaned: DataFrame
    scores: DataFrame
    audit: DataFrame
    issues: DataFrame
    affected: DataFrame

    def report(self, as_of: str | None = None) -> DataFrame:
        """Row of the quality-reports table with the nested profile document."""
        raw = self.result.raw
        profile = materialise(profile_columns(raw), "profile")
        measured = measure(raw, as_of, profile=profile)
        plan = materialise(decide(measured), "plan")
        document = profile_document(
            profile_metadata(raw, self.name),
            self._columns(raw, measured),
            self.issues,
            recommendations(plan),
            compare_scores(self.scores),
            sorted(r["column_name"] for r in plan.filter("action = 'DROP_COLUMN'").select("column_name").collect()),
        )
        return report_row(document, self.scores, audit_totals(self.audit), self.issues)


    def _columns(self, raw: DataFrame, measured: DataFrame) -> DataFrame:
        """Column profiles with class, range, first values of categories, and issues found."""
        columns = measured.select("column_name", "data_type", "total_rows", "null_count", "null_pct", "distinct_count", "column_class")
        numbers = [f.name for f in raw.schema.fields if isinstance(f.dataType, T.NumericType)]
        if numbers:
            ranges = column_ranges(raw, numbers).select("column_name", "min_value", "max_value")
            columns = columns.join(F.broadcast(ranges), "column_name", "left")
        categories = [r["column_name"] for r in columns.filter("column_class = 'CATEGORY'").select("column_name").collect()]
        if categories:
            columns = columns.join(F.broadcast(value_lists(raw, categories)), "column_name", "left")
        found = self.issues.filter("issue_rows > 0").groupBy("column_name").agg(F.sort_array(F.collect_list("issue")).alias("issues"))
        return columns.join(F.broadcast(found), "column_name", "left")


def prepare(df: DataFrame, domain: Domain, masters: dict[str, DataFrame] | None = None, **options) -> Prepared:
    """Clean one table, write it once with its audit counted in the same job, score both layers."""
    result = domain.clean(df, masters, **options)
    cleaned = result.store(f"clean-{domain.name}")
    before, after = (measure_layer(layer, domain, masters) for layer in (df, cleaned))
    scores = score_layers({"raw": before.scores, "cleaned": after.scores}, domain.name)
    return Prepared(domain.name, result, cleaned, scores, result.audit(), before.issues, before.affected)


def run(
    tables: dict[str, tuple[DataFrame, Domain]],
    datasets: list[str] | None = None,
    layers: list[str] | None = None,
    masters: dict[str, DataFrame] | None = None,
) -> dict[tuple[str, str], DataFrame]:
    """Frames by (layer, dataset) for the chosen datasets and layers (default: all)."""
    wanted = layers or ["raw", "cleaned", "profiles"]
    out: dict[tuple[str, str], DataFrame] = {}
    for name, (df, domain) in tables.items():
        if datasets is not None and name not in datasets:
            continue
        if "raw" in wanted:
            out[("raw", name)] = df
        if "cleaned" in wanted or "profiles" in wanted:
            done = prepare(df, domain, masters)
            if "cleaned" in wanted:
                out[("cleaned", name)] = done.cleaned
            if "profiles" in wanted:
                out[("profiles", name)] = done.scores
    return out


def all_scores(prepared: list[Prepared]) -> DataFrame:
    return reduce(DataFrame.unionByName, [p.scores for p in prepared])
