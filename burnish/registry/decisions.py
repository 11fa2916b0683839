"""Decision tree queries (section F)."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnish.dirty import table
from burnish.plans import decide as T
from burnish.plans.engine import build_stages, clean
from burnish.plans.rules import load_rules, override, rules_frame, validate_rules
from burnish.registry.base import AS_OF, AS_OF_EVENTS, LOWERED_EMAIL, ctes, define, domain, query, raw
from burnish.registry.profiles import union
from burnish.session import materialise

# Class of every column by its name and type; None: a text's number of values decides.
VIEW_CLASSES = {
    "orders": {
        "row_seq": "NUMERIC_PK", "order_id": "NUMERIC_PK", "customer_id": "REFERENCE", "order_date": "TEMPORAL",
        "order_amount": "MONETARY", "total_amount": "MONETARY", "status": None, "industry": None, "customer_name": "PII",
        "email": "PII", "nps_score": "NUMERIC", "health_score": "NUMERIC", "seats_used": "NUMERIC", "arr": "MONETARY",
        "mrr": "MONETARY", "onboarding_date": "TEMPORAL", "go_live_date": "TEMPORAL", "phone": "PII", "usage_index": "NUMERIC",
        "refund_code": None,
    },
    "telemetry": {
        "row_seq": "NUMERIC_PK", "device_id": "REFERENCE", "reading_timestamp": "TEMPORAL", "ingestion_timestamp": "TEMPORAL",
        "device_status": None, "firmware_version": None, "device_type": None,
        **dict.fromkeys(
            ["temperature_c", "humidity_pct", "pressure_psi", "vibration_hz", "voltage_v", "current_a", "power_kw", "efficiency_pct",
             "predicted_failure_days", "torque_nm"], "NUMERIC",
        ),
    },
    "workforce": {
        "row_seq": "NUMERIC_PK", "employee_id": "NUMERIC_PK", "manager_id": "REFERENCE", "full_name": "PII", "email": "PII",
        "hire_date": "TEMPORAL", "termination_date": "TEMPORAL", "department": None, "employment_status": None,
        **dict.fromkeys(["base_salary", "bonus_target", "equity_grant", "total_comp", "salary_band_max"], "MONETARY"),
        **dict.fromkeys(["perf_rating_2024", "pto_days_used", "pto_days_remaining"], "NUMERIC"),
    },
    "catalog": {
        "row_seq": "NUMERIC_PK", "product_id": "NUMERIC_PK", "price_usd": "MONETARY", "price_eur": "MONETARY",
        **dict.fromkeys(["margin_pct", "stock_quantity", "weight_kg", "weight_lbs"], "NUMERIC"),
        **dict.fromkeys(["category_l1", "description_en", "product_name_hi", "product_name_ja"], None),
        "created_at": "TEMPORAL", "published_at": "TEMPORAL",
    },
}
CLASSES = {c: k or "CATEGORY" for c, k in VIEW_CLASSES["orders"].items() if c not in ("phone", "usage_index", "refund_code")}
# The orders, with a phone, a measure that another predicts, and something that names refunds.
_EXTENDED = (
    "SELECT *, concat('+1 212 555 ', lpad(CAST(row_seq % 9000 + 1000 AS {text}), 4, '0')) AS phone, "
    "CASE WHEN row_seq % 20 < 3 THEN NULL ELSE seats_used * 2 + 1 END AS usage_index, "
    "CASE WHEN row_seq % 3 = 0 THEN 'R1' ELSE 'R2' END AS refund_code FROM "
)
define("extended_orders", _EXTENDED.format(text="VARCHAR") + "dirty_orders", "dirty_orders")
_FENCE = "quantile_cont({c}, 0.75) + 3 * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25))"
SCHEDULED = ("order_date", "go_live_date")


def _predicted(view: str, source: str, target: str) -> str:
    others = [c for c, k in VIEW_CLASSES[view].items() if k == "NUMERIC" and c != target]
    return "(" + " OR ".join(f"coalesce((SELECT abs(corr({target}, {c})) FROM {source}) > 7e-1, false)" for c in others) + ")"


def _measures(view: str, source: str, as_of: str) -> str:
    """One row per column with what the tree reads, in SQL."""
    parts = []
    for c, cls in VIEW_CLASSES[view].items():
        numeric = cls in ("MONETARY", "NUMERIC")
        skew = (
            f"(SELECT avg(power({c} - a, 3)) / power(any_value(s), 3) FROM {source}, "
            f"(SELECT avg({c}) AS a, stddev_pop({c}) AS s FROM {source}))"
            if numeric
            else "CAST(NULL AS DOUBLE)"
        )
        outliers = (
            f"(SELECT count(*) FILTER ({c} > b) * 100 / count({c}) FROM {source}, (SELECT {_FENCE.format(c=c)} AS b FROM {source}))"
            if numeric
            else "0"
        )
        kind = f"'{cls}'" if cls else f"CASE WHEN count(DISTINCT {c}) > 2e-1 * count({c}) THEN 'TEXT' ELSE 'CATEGORY' END"
        parts.append(
            f"SELECT '{c}' AS column_name, {kind} AS cls, count(*) - count({c}) AS nulls, "
            f"round((count(*) - count({c})) * 100 / count(*), 2) AS pct, count({c}) - count(DISTINCT {c}) AS copies, "
            f"{f'count(*) FILTER ({c} < 0)' if numeric else '0'} AS neg, {skew} AS skew, {outliers} AS outl, "
            + (f"count(*) FILTER ({c} > TIMESTAMP '{as_of}')" if cls == "TEMPORAL" else "0")
            + f" AS futures, {str(c in SCHEDULED).lower()} AS scheduled, "
            + (_predicted(view, source, c) if cls == "NUMERIC" else "false")
            + f" AS predicted FROM {source}"
        )
    return union(parts)


_TREE = [
    ("DELETE_NULL_KEY", "PK_NULL", "cls = 'NUMERIC_PK' AND nulls > 0"),
    ("DELETE_DUPLICATES", "PK_VIOLATION", "cls = 'NUMERIC_PK' AND copies > 0"),
    ("DELETE_NULL_TEMPORAL", "TEMPORAL_NULL_LOW", "cls = 'TEMPORAL' AND nulls > 0 AND pct < 5"),
    ("FLAG_NULL", "TEMPORAL_NULL_HIGH", "cls = 'TEMPORAL' AND nulls > 0 AND pct >= 5"),
    ("FLAG_FUTURE", "TEMPORAL_SCHEDULED", "cls = 'TEMPORAL' AND futures > 0 AND scheduled"),
    ("DELETE_FUTURE", "TEMPORAL_FUTURE", "cls = 'TEMPORAL' AND futures > 0 AND NOT scheduled"),
    ("FLAG_NULL", "MONETARY_NULL", "cls = 'MONETARY' AND nulls > 0"),
    ("CONVERT_TO_POSITIVE", "MONETARY_NEGATIVE", "cls = 'MONETARY' AND neg > 0 AND refund"),
    ("FLAG_NEGATIVE", "MONETARY_NEGATIVE", "cls = 'MONETARY' AND neg > 0 AND NOT refund"),
    ("FLAG_OUTLIER", "MONETARY_OUTLIER", "cls = 'MONETARY' AND outl > 0 AND outl < 5"),
    ("FLAG_DISTRIBUTION", "MONETARY_OUTLIER", "cls = 'MONETARY' AND outl >= 5"),
    ("NULLIFY_MALFORMED", "PII_EMAIL", "cls = 'PII' AND contains(column_name, 'mail')"),
    ("STANDARDIZE_PHONE", "PII_PHONE", "cls = 'PII' AND contains(column_name, 'phone')"),
    ("TRIM_WHITESPACE", "PII_CLEANUP", "cls = 'PII' AND contains(column_name, 'name')"),
    ("IMPUTE_MEDIAN", "NUMERIC_NULL_LOW", "cls = 'NUMERIC' AND nulls > 0 AND pct < 10 AND skew > 2"),
    ("IMPUTE_MEAN", "NUMERIC_NULL_LOW", "cls = 'NUMERIC' AND nulls > 0 AND pct < 10 AND skew <= 2"),
    ("IMPUTE_REGRESSION", "NUMERIC_NULL_MEDIUM", "cls = 'NUMERIC' AND nulls > 0 AND pct BETWEEN 10 AND 30 AND predicted"),
    ("IMPUTE_MEDIAN", "NUMERIC_NULL_MEDIUM", "cls = 'NUMERIC' AND nulls > 0 AND pct BETWEEN 10 AND 30 AND NOT predicted"),
    ("DROP_COLUMN", "NUMERIC_NULL_HIGH", "cls = 'NUMERIC' AND pct > 30"),
    ("CAP_P99", "NUMERIC_OUTLIER", "cls = 'NUMERIC' AND outl BETWEEN 1 AND 5"),
    ("FLAG_DISTRIBUTION", "NUMERIC_OUTLIER", "cls = 'NUMERIC' AND outl > 5"),
    ("STANDARDIZE", "CATEGORY_CONSISTENCY", "cls = 'CATEGORY'"),
    ("IMPUTE_MODE", "TEXT_NULL_LOW", "cls = 'CATEGORY' AND nulls > 0 AND pct < 5"),
    ("IMPUTE_UNKNOWN", "TEXT_NULL_MEDIUM", "cls = 'CATEGORY' AND nulls > 0 AND pct BETWEEN 5 AND 15"),
    ("FLAG_NULL", "TEXT_NULL_HIGH", "cls = 'CATEGORY' AND pct > 15"),
]


def decided_sql(view: str, source: str, as_of: str, refund: bool) -> str:
    """The tree over one view: a CTE ``m`` of measures, then one SELECT per action."""
    chosen = union(
        [
            f"SELECT column_name, cls AS column_class, pct AS null_pct, '{a}' AS action, '{r}' AS rule FROM m WHERE {w}"
            for a, r, w in _TREE
        ]
    )
    return ctes(source) + f", m AS (SELECT *, {str(refund).lower()} AS refund FROM ({_measures(view, source, as_of)})) {chosen}"


# Rows that break something known about the columns; telemetry and workforce.
CONSTRAINTS = {
    "telemetry": [
        T.sequence("reading_timestamp", "ingestion_timestamp"),
        T.bounds("efficiency_pct", 0, 100),
        T.Constraint("physics", "power_kw", "power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9)"),
        T.bounds("humidity_pct", -1e6, 1e6),
    ],
    "workforce": [
        T.sequence("hire_date", "termination_date"),
        T.bounds("perf_rating_2024", 1, 5),
        T.Constraint("identity", "total_comp", "total_comp < base_salary", "base_salary + coalesce(bonus_target, 0)"),
        T.Constraint("orphan", "manager_id", "manager_id >= 1000000000"),
    ],
    "catalog": [T.Constraint("balance", "price_usd", "category_l1", "price_eur"), T.Constraint("balance", "weight_kg", "category_l1", "weight_kg")],
}
_BROKEN = {
    "telemetry": "SELECT 'reading_timestamp/ingestion_timestamp', NULL, NULL, 'DELETE_ROWS', 'IMPOSSIBLE_SEQUENCE' FROM dirty_telemetry HAVING count(*) FILTER (reading_timestamp > ingestion_timestamp) > 0 "
    "UNION ALL SELECT 'efficiency_pct', 'NUMERIC', (SELECT pct FROM m WHERE column_name = 'efficiency_pct'), 'CAP_RANGE', 'DOMAIN_BOUNDS' FROM dirty_telemetry HAVING count(*) FILTER (efficiency_pct < 0 OR efficiency_pct > 100) > 0 "
    "UNION ALL SELECT 'power_kw', 'NUMERIC', (SELECT pct FROM m WHERE column_name = 'power_kw'), 'FLAG_PHYSICS', 'PHYSICS' FROM dirty_telemetry HAVING count(*) FILTER (power_kw > voltage_v * current_a * 1e-3 * (1 + 1e-9)) > 0",
    "workforce": "SELECT 'hire_date/termination_date', NULL, NULL, 'DELETE_ROWS', 'IMPOSSIBLE_SEQUENCE' FROM dirty_workforce HAVING count(*) FILTER (hire_date > termination_date) > 0 "
    "UNION ALL SELECT 'perf_rating_2024', 'NUMERIC', (SELECT pct FROM m WHERE column_name = 'perf_rating_2024'), 'CAP_RANGE', 'DOMAIN_BOUNDS' FROM dirty_workforce HAVING count(*) FILTER (perf_rating_2024 < 1 OR perf_rating_2024 > 5) > 0 "
    "UNION ALL SELECT 'total_comp', 'MONETARY', (SELECT pct FROM m WHERE column_name = 'total_comp'), 'RECOMPUTE', 'LOGIC_VIOLATION' FROM dirty_workforce HAVING count(*) FILTER (total_comp < base_salary) > 0 "
    "UNION ALL SELECT 'manager_id', 'REFERENCE', (SELECT pct FROM m WHERE column_name = 'manager_id'), 'FLAG_ORPHAN', 'FK_VIOLATION' FROM dirty_workforce HAVING count(*) FILTER (manager_id >= 1000000000) > 0",
    "catalog": "SELECT 'price_usd', 'MONETARY', (SELECT pct FROM m WHERE column_name = 'price_usd'), 'FLAG_JOURNAL', 'JOURNAL_BALANCE' FROM (SELECT category_l1 FROM dirty_catalog "
    "GROUP BY category_l1 HAVING abs(sum(price_usd) - sum(price_eur)) > 1e-2) HAVING count(*) > 0",
}


def extended(spark, sf_dir):
    return spark.sql(_EXTENDED.format(text="STRING") + "{orders}", orders=raw(spark, sf_dir, "orders"))


def plan(spark, sf_dir):
    return T.decide(T.measure(extended(spark, sf_dir), AS_OF))


_DECIDE = decided_sql("orders", "extended_orders", AS_OF, True)


@query("f1_decide", _DECIDE)
def _decide(spark, sf_dir):
    return plan(spark, sf_dir).drop("predictor", "detail")


for _view, _as_of in (("telemetry", AS_OF_EVENTS), ("workforce", AS_OF), ("catalog", "2023-06-01")):

    @query(f"f1_decide_{_view}", decided_sql(_view, f"dirty_{_view}", _as_of, False) + " UNION ALL " + _BROKEN[_view])
    def _decide_view(spark, sf_dir, view=_view, as_of=_as_of):
        """The tree with what is known about the view's columns; none of them names a refund."""
        df = raw(spark, sf_dir, view)
        broken = T.broken_constraints(df, CONSTRAINTS[view])
        return T.decide(T.measure(df, as_of), broken=broken).drop("predictor", "detail")


# Text columns of tables from five rows to many: a table's size does not decide on the class.
TEXT_COLUMNS = {
    "region": {"r_name": None}, "nation": {"n_name": None}, "supplier": {"s_name": "PII"},
    "customer": {"c_name": "PII", "c_mktsegment": None}, "part": {"p_name": None, "p_brand": None, "p_type": None},
}


@query(
    "f1_classes_small",
    union(
        [
            f"SELECT '{t}' AS table_name, '{c}' AS column_name, "
            + (f"max('{k}')" if k else f"CASE WHEN count(DISTINCT {c}) > 2e-1 * count({c}) THEN 'TEXT' ELSE 'CATEGORY' END")
            + f" AS column_class FROM {t}"
            for t, columns in TEXT_COLUMNS.items()
            for c, k in columns.items()
        ]
    ),
)
def _classes_small(spark, sf_dir):
    from functools import reduce

    from burnish.operators.profile import profile_columns

    def classes(name, columns):
        profile = profile_columns(table(spark, sf_dir, name).select(*columns))
        return T.classify_columns(profile).select(F.lit(name).alias("table_name"), "column_name", "column_class")

    return reduce(lambda a, b: a.unionByName(b), [classes(t, list(c)) for t, c in TEXT_COLUMNS.items()])


define(
    "decided_live",
    f"SELECT * FROM orders_first WHERE NOT coalesce(onboarding_date > TIMESTAMP '{AS_OF}', false)",
    "orders_first",
)


@query(
    "f1_decided_clean",
    ctes("decided_live")
    + "SELECT row_seq, order_id, order_amount, coalesce(nps_score, (SELECT median(nps_score) FROM decided_live)) AS nps_score, "
    "coalesce(health_score, (SELECT avg(health_score) FROM decided_live)) AS health_score, s.canonical AS status, i.canonical AS industry, "
    f"CASE WHEN industry IS NULL THEN 'NULL_VALUE' END AS industry_flag, trim(customer_name) AS customer_name, {LOWERED_EMAIL} AS email "
    "FROM decided_live LEFT JOIN (SELECT upper(trim(status)) AS cluster, trim(arg_max(status, (n, status))) AS canonical FROM "
    "(SELECT status, count(*) AS n FROM dirty_orders GROUP BY status) GROUP BY 1) s ON upper(trim(status)) = s.cluster "
    "LEFT JOIN (SELECT upper(trim(industry)) AS cluster, trim(arg_max(industry, (n, industry))) AS canonical FROM "
    "(SELECT industry, count(*) AS n FROM dirty_orders WHERE industry IS NOT NULL GROUP BY industry) GROUP BY 1) i ON upper(trim(industry)) = i.cluster",
)
def _decided_clean(spark, sf_dir):
    """The tree's own rules on the table they were decided for: order_id named as its key, spellings learned."""
    df = raw(spark, sf_dir, "orders")
    plan = T.decide(T.measure(df, AS_OF))
    spellings = T.learn_spellings(df, plan)
    rules, dropped = T.plan_to_rules(plan, AS_OF, ["order_id"], spellings)
    frame = clean(df.drop(*dropped), rules, ["row_seq"], spellings=spellings).frame
    return frame.select(
        "row_seq", "order_id", "order_amount", "nps_score", "health_score", "status", "industry", "industry_flag", "customer_name", "email"
    )


@query(
    "f2_load_rules",
    ctes("dirty_orders", "orders_live")
    + "SELECT row_seq, coalesce(nps_score, (SELECT avg(nps_score) FROM orders_live)) AS nps_score, health_score FROM orders_live",
)
def _load_rules(spark, sf_dir):
    """Rules read back from a config table, one of them overridden and one dropped."""
    stored = load_rules(rules_frame(spark, "orders", domain("orders").rules), "orders")
    mean = next(r for r in stored if r.name == "NULL_health_score")
    from dataclasses import replace

    from burnish.plans.rules import Stat

    nps = replace(
        mean, name="NULL_nps_score", column="nps_score", when="nps_score IS NULL", value="{nps_mean}",
        stats=(Stat("nps_mean", "mean", "nps_score"),),
    )
    rules = override(stored, {"NULL_nps_score": nps, "NULL_health_score": None})
    validate_rules(rules, CLASSES)
    frame = clean(raw(spark, sf_dir, "orders"), rules, ["row_seq"]).frame
    return frame.select("row_seq", "nps_score", "health_score")


@query("f3_recommendations", f"SELECT action, column_name, rule FROM ({_DECIDE})")
def _recommendations(spark, sf_dir):
    return T.recommendations(plan(spark, sf_dir))


_STAGE = {
    "key": ("DELETE_DUPLICATES",),
    "impossible": ("DELETE_NULL_TEMPORAL", "DELETE_FUTURE"),
    "flag": ("FLAG_NULL", "FLAG_FUTURE", "FLAG_DISTRIBUTION"),
    "money": ("CONVERT_TO_POSITIVE", "FLAG_NEGATIVE", "FLAG_OUTLIER"),
    "text": ("NULLIFY_MALFORMED", "STANDARDIZE_PHONE", "TRIM_WHITESPACE", "STANDARDIZE"),
    "bounds": ("CAP_P99",),
    "impute": ("IMPUTE_MEDIAN", "IMPUTE_MEAN", "IMPUTE_MODE", "IMPUTE_UNKNOWN", "IMPUTE_REGRESSION"),
}
_STAGES = union([f"SELECT {i} AS place, '{s}' AS stage, '{a}' AS action" for i, (s, acts) in enumerate(_STAGE.items()) for a in acts])


@query(
    "f4_build_stages",
    "SELECT CAST(dense_rank() OVER (ORDER BY place) - 1 AS INT) AS stage_no, stage, rule || '_' || column_name AS rule, action, column_name, "
    f"CAST(round((SELECT count(*) FROM orders) * (100 - null_pct) / 100) AS BIGINT) AS filled_rows FROM ({_DECIDE}) JOIN ({_STAGES}) USING (action) "
    "WHERE action <> 'DELETE_DUPLICATES' OR column_name = 'order_id'",
)
def _stages(spark, sf_dir):
    """Stage order of the decided rules, with the rows of each rule's column that are filled."""
    decided = materialise(plan(spark, sf_dir), "plan")
    rules, _ = T.plan_to_rules(decided, AS_OF, ["order_id"])
    validate_rules(rules, {r["column_name"]: r["column_class"] for r in decided.select("column_name", "column_class").distinct().collect()})
    rows = [(i, s, r.name, r.action, r.column) for i, (s, group) in enumerate(build_stages(rules)) for r in group]
    stages = spark.createDataFrame(rows, "stage_no int, stage string, rule string, action string, column_name string")
    rates = decided.select("column_name", "null_pct").distinct()
    total = table(spark, sf_dir, "orders").agg(F.count(F.lit(1)).alias("n")).scalar()
    filled = F.round(total * (100 - F.col("null_pct")) / 100).cast("bigint").alias("filled_rows")
    return stages.join(rates, "column_name").select(*stages.columns, filled)


@query(
    "f6_schema_drift",
    "SELECT 'c_segment' AS column_name, NULL AS current_type, 'string' AS catalog_type, 'REMOVED' AS change "
    "UNION ALL SELECT 'c_mktsegment', 'string', NULL, 'ADDED' UNION ALL SELECT 'c_acctbal', 'double', 'bigint', 'RETYPED'",
)
def _drift(spark, sf_dir):
    from burnish.operators.profile import profile_columns

    customer = table(spark, sf_dir, "customer")
    stored = profile_columns(customer).select(
        F.when(F.col("column_name") == "c_mktsegment", F.lit("c_segment")).otherwise(F.col("column_name")).alias("column_name"),
        F.when(F.col("column_name") == "c_acctbal", F.lit("bigint")).otherwise(F.col("data_type")).alias("data_type"),
    )
    return T.schema_drift(customer, stored)


# What a catalog knew: no refunds, no index, an old column more, and amounts kept as text.
_KNOWN = "SELECT * EXCLUDE (refund_code, usage_index, total_amount), CAST(total_amount AS VARCHAR) AS total_amount, CAST(row_seq % 7 AS DOUBLE) AS legacy_score FROM extended_orders"
define("known_orders", _KNOWN, "extended_orders")
_CHANGES = {"refund_code": "ADDED", "usage_index": "ADDED", "total_amount": "RETYPED", "legacy_score": "REMOVED"}


def _reclassified(spark, sf_dir):
    """Catalog of the orders as they were stored, read back and brought up to the columns of today."""
    from burnish.plans import catalog as K
    from burnish.session import shared_path

    now = extended(spark, sf_dir)
    known = now.drop("refund_code", "usage_index").withColumn("total_amount", F.col("total_amount").cast("string"))
    known = known.withColumn("legacy_score", (F.col("row_seq") % 7).cast("double"))
    path = shared_path(spark, "catalog")
    K.save_version(T.measure(known, AS_OF), path, 1)
    return K.reclassify(now, K.load_version(spark, path), AS_OF)


@query("f6_reclassify_plan", _DECIDE)
def _reclassify_plan(spark, sf_dir):
    """The plan after a change of schema equals the plan of a whole run."""
    return _reclassified(spark, sf_dir)[0].drop("predictor", "detail")


VIEW_CLASSES["known"] = {**{c: k for c, k in VIEW_CLASSES["orders"].items() if c not in ("refund_code", "usage_index")}, "total_amount": None, "legacy_score": "NUMERIC"}


def _acts(plan_sql: str, measures: str, prefix: str) -> str:
    return (
        f"SELECT column_name, any_value(cls) AS {prefix}_class, "
        f"nullif(coalesce(string_agg(DISTINCT action, ',' ORDER BY action), ''), '') AS {prefix}_actions "
        f"FROM ({measures}) LEFT JOIN (SELECT column_name, action FROM ({plan_sql})) USING (column_name) GROUP BY column_name"
    )


_OLD = _acts(decided_sql("known", "known_orders", AS_OF, False), _measures("known", "known_orders", AS_OF), "old")
_NEW = _acts(_DECIDE, _measures("orders", "extended_orders", AS_OF), "new")


@query(
    "f6_reclassify_changes",
    ctes("known_orders")
    + ", change AS ("
    + union([f"SELECT '{c}' AS column_name, '{k}' AS change" for c, k in _CHANGES.items()])
    + f") SELECT column_name, change, old_class, new_class, old_actions, new_actions FROM ({_OLD}) FULL JOIN ({_NEW}) USING (column_name) "
    "LEFT JOIN change USING (column_name) WHERE change IS NOT NULL OR old_class IS DISTINCT FROM new_class OR old_actions IS DISTINCT FROM new_actions",
)
def _reclassify_changes(spark, sf_dir):
    """Columns whose type, class or actions are no longer those of the catalog."""
    return _reclassified(spark, sf_dir)[1]
