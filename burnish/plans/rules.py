"""Rules and checks as plain data, so they can live in a table or a JSON file.

Conditions and values are Spark SQL expressions over the table's columns; a statistic
of the table is written ``{name}`` and filled in before the expression is parsed.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from burnish.functions import numbers as N
from burnish.functions import text as X
from burnish.operators.language import wrong_language

# Fixed order of work.  Rules of one stage see the values the stage started with.
STAGES = (
    "key",
    "impossible",
    "flag",
    "money",
    "derive",
    "round",
    "text",
    "bounds",
    "impute",
    "logic",
    "reference",
)

# Named column functions a rule may use as its new value.
FUNCTIONS = {
    "abs": N.abs_value,
    "clip": N.clip,
    "round2": N.round2,
    "to_number": N.to_number,
    "trim": X.trim_ws,
    "upper": X.upper,
    "lower": X.lower,
    "title": X.title_case,
    "email": X.clean_email,
    "phone": X.clean_phone,
    "map": X.map_values,
    "synonyms": X.standardise_rule,
    "version": X.clean_version,
    "account_code": X.clean_account_code,
    "strip_html": X.strip_html,
}

# Named column tests a rule or check may use as its condition.
TESTS = {"wrong_language": wrong_language}

CLASSES = ("MONETARY", "PII", "TEMPORAL", "NUMERIC_PK", "NUMERIC", "CATEGORY", "TEXT")
NEVER_IMPUTE = ("MONETARY", "PII")


@dataclass(frozen=True)
class Stat:
    """Statistic over the surviving rows: quantile, mean, mode, skewness…"""

    name: str
    kind: str
    value: str
    q: float = 0.5
    where: str | None = None
    other: str | None = None


@dataclass(frozen=True)
class Rule:
    name: str
    stage: str
    action: str
    column: str
    when: str | None = None
    value: str | None = None
    fn: str | None = None
    args: dict = field(default_factory=dict)
    flag: str | None = None
    label: str | None = None
    stats: tuple[Stat, ...] = ()
    keys: tuple[str, ...] = ()
    test: str | None = None

    @property
    def deletes(self) -> bool:
        return self.stage in ("key", "impossible")

    @property
    def changes_value(self) -> bool:
        return self.value is not None or self.fn is not None


@dataclass(frozen=True)
class Check:
    """Issue test: a condition, a named test, or else "differs from its canonical form"."""

    name: str
    dimension: str
    severity: str
    column: str
    when: str | None = None
    fn: str | None = None
    args: dict = field(default_factory=dict)
    test: str | None = None

    def predicate(self) -> Column:
        if self.test is not None:
            return N.holds(TESTS[self.test](F.col(self.column), **self.args))
        if self.when is not None:
            return N.holds(F.expr(self.when))
        value = F.col(self.column)
        return N.holds(value != FUNCTIONS[self.fn](value, **self.args))


@dataclass(frozen=True)
class Reference:
    """Foreign key by master table: ``master`` names a frame given at run time."""

    column: str
    master: str
    key: str
    mark: str


@dataclass(frozen=True)
class Balance:
    """Per-group identity: the sums of ``a`` and ``b`` agree within ``tol``."""

    key: str
    a: str
    b: str
    mark: str
    tol: float = 0.01
    where: str | None = None


def literal(value) -> str:
    """A statistic as a Spark SQL literal."""
    if value is None:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return f"{value}L" if -(2**63) < value < 2**63 else f"CAST('{value}' AS DECIMAL(38,0))"
    if isinstance(value, Decimal):
        return f"CAST('{value:f}' AS DECIMAL(38,{max(0, -value.as_tuple().exponent)}))"
    if isinstance(value, datetime):
        return f"TIMESTAMP_NTZ'{value.replace(tzinfo=None).isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE'{value.isoformat()}'"
    return f"CAST('{float(value)!r}' AS DOUBLE)"


def fill_stats(expression: str, stats: dict) -> str:
    for name, value in stats.items():
        expression = expression.replace("{" + name + "}", literal(value))
    return expression


def validate_rules(rules: list[Rule], classes: dict[str, str]) -> None:
    """Reject rules that would invent money or personal data, or that cannot run."""
    for rule in rules:
        if rule.stage not in STAGES:
            raise ValueError(f"{rule.name}: unknown stage {rule.stage}")
        if rule.fn is not None and rule.fn not in FUNCTIONS:
            raise ValueError(f"{rule.name}: unknown function {rule.fn}")
        if rule.test is not None and rule.test not in TESTS:
            raise ValueError(f"{rule.name}: unknown test {rule.test}")
        if rule.action.startswith("IMPUTE") and classes.get(rule.column) in NEVER_IMPUTE:
            raise ValueError(f"{rule.name}: {rule.column} is {classes[rule.column]} and is never imputed")


def rule_to_json(rule: Rule) -> str:
    return json.dumps(asdict(rule))


def rule_from_dict(data: dict) -> Rule:
    data = {k: v for k, v in data.items() if v is not None}
    data["stats"] = tuple(Stat(**s) for s in data.get("stats", ()))
    data["keys"] = tuple(data.get("keys", ()))
    return Rule(**data)


def rules_frame(spark: SparkSession, table: str, rules: list[Rule]) -> DataFrame:
    """Rules as rows of a config table (one JSON body per rule)."""
    rows = [(table, i, r.name, r.action, r.column, rule_to_json(r)) for i, r in enumerate(rules)]
    return spark.createDataFrame(
        rows, "table_name string, position int, rule string, action string, column_name string, body string"
    )


def load_rules(source: DataFrame | str, table: str | None = None) -> list[Rule]:
    """Rules from a config table (see ``rules_frame``) or from a JSON / YAML file."""
    if isinstance(source, DataFrame):
        rows = source if table is None else source.filter(F.col("table_name") == table)
        return [rule_from_dict(json.loads(r["body"])) for r in rows.orderBy("position").collect()]
    with open(source, encoding="utf-8") as handle:
        if source.endswith((".yaml", ".yml")):
            try:
                import yaml
            except ImportError as error:  # optional reader
                raise RuntimeError("reading YAML rules needs the yaml module") from error
            data = yaml.safe_load(handle)
        else:
            data = json.load(handle)
    return [rule_from_dict(item) for item in data]


def override(rules: list[Rule], changes: dict[str, Rule | None]) -> list[Rule]:
    """Replace rules by name, or drop them with ``None``, without touching code."""
    out = []
    for rule in rules:
        if rule.name in changes:
            rule = changes[rule.name]
        if rule is not None:
            out.append(rule)
    return out
