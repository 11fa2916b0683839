"""Source, sink and load queries (section A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from burnish.dirty import TABLES, dirty, table
from burnish.functions import numbers as N
from burnish.plans.prepare import prepare, run
from burnish.registry.base import AS_OF, ctes, domain, query, raw
from burnish.registry.decisions import decided_sql
from burnish.registry.profiles import union
from burnish.session import materialise, shared_path
from burnish.sources import files as S
from burnish.sources import load as L
from burnish.sources import typing as Y

ORDERS_TEXT = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)


def _csv(spark, sf_dir, name: str) -> str:
    path = shared_path(spark, f"csv-{name}")
    S.write_csv(table(spark, sf_dir, name), path)
    return path


@query("a1_read_csv_table", "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def _read_csv(spark, sf_dir):
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL(ORDERS_TEXT)
    return S.read_csv_table(spark, _csv(spark, sf_dir, "orders"), schema).drop("o_orderdate")


_TOKENS = (
    "CASE o_orderkey % 8 WHEN 0 THEN '' WHEN 1 THEN 'NULL' WHEN 2 THEN 'None' WHEN 3 THEN 'nan' WHEN 4 THEN 'NaN' "
    "WHEN 5 THEN 'NaT' ELSE o_orderpriority END"
)


@query(
    "a2_normalise_null_tokens",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 8 < 6 THEN NULL ELSE o_orderpriority END AS priority, o_orderstatus FROM orders",
)
def _tokens(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(_TOKENS).alias("priority"), "o_orderstatus")
    return S.normalise_null_tokens(text)


@query(
    "a3_read_csv_permissive",
    "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 10 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus, "
    "o_orderkey % 10 IN (0, 1) AS odd_row FROM orders",
)
def _permissive(spark, sf_dir):
    """Rows one field short or long are read, and their text is kept beside them."""
    line = F.concat_ws(
        ",",
        F.col("o_orderkey").cast("string"),
        F.col("o_custkey").cast("string"),
        F.when(F.col("o_orderkey") % 10 != 0, F.col("o_orderstatus")),
        F.when(F.col("o_orderkey") % 10 == 1, F.lit("extra")),
    )
    path = shared_path(spark, "ragged")
    lines = table(spark, sf_dir, "orders").select(line.alias("o_orderkey,o_custkey,o_orderstatus"))
    lines.write.option("header", True).option("sep", "\u0001").csv(path)
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING")
    read = S.read_csv_table(spark, path, schema, permissive=True)
    return read.select("o_orderkey", "o_custkey", "o_orderstatus", F.col(S.CORRUPT).isNotNull().alias("odd_row"))


@query(
    "a4_infer_types",
    "SELECT column_name, CASE WHEN column_name IN ('o_orderkey', 'o_custkey') THEN 'bigint' WHEN column_name = 'o_totalprice' THEN 'double' "
    "WHEN column_name = 'order_date' THEN 'timestamp_ntz' ELSE 'string' END AS data_type, "
    "regexp_matches(lower(column_name), '(?:^|_)(?:date|timestamp|time)(?:_|$)|_at$') AS temporal_name "
    "FROM (DESCRIBE SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate AS order_date, o_orderpriority FROM orders)",
)
def _infer(spark, sf_dir):
    path = shared_path(spark, "csv-orders")
    S.write_csv(table(spark, sf_dir, "orders").withColumnRenamed("o_orderdate", "order_date"), path)
    text = S.read_csv_table(spark, path)
    moments = [c for c in text.columns if Y.is_temporal_name(c)]
    return Y.infer_types(text).select("column_name", "data_type", F.col("column_name").isin(moments).alias("temporal_name"))


def _inferred(spark, df, column: str):
    """Type inferred for one column of a written CSV, and what the casts then keep and reject."""
    path = shared_path(spark, "csv-inferred")
    S.write_csv(df, path)
    text = S.read_csv_table(spark, path)
    types = Y.inferred_schema(Y.infer_types(text))
    ok, rejected = Y.cast_or_reject(text, types)
    kept = ok.agg(F.count(F.lit(1)).alias("loaded_rows"), F.max(F.col(column).cast("string")).alias("largest"))
    lost = rejected.agg(F.count(F.lit(1)).alias("n")).scalar()
    return kept.select(F.lit(types[column]).alias("data_type"), "loaded_rows", lost.alias("rejected_rows"), "largest")


_LATE = "CASE WHEN l_orderkey * 10 > {most} * 9 THEN concat('C', CAST(l_orderkey AS {text})) ELSE CAST(l_orderkey AS {text}) END"


@query(
    "a4_infer_types_late_text",
    "SELECT 'string' AS data_type, count(*) AS loaded_rows, CAST(0 AS BIGINT) AS rejected_rows, max("
    + _LATE.format(most="(SELECT max(l_orderkey) FROM lineitem)", text="VARCHAR")
    + ") AS largest FROM lineitem",
)
def _infer_late(spark, sf_dir):
    """Whole numbers first, codes in the last tenth: text, and every row is kept."""
    lines = table(spark, sf_dir, "lineitem")
    most = lines.agg(F.max("l_orderkey").alias("most")).scalar()
    coded = lines.withColumn("_most", most).select(F.expr(_LATE.format(most="_most", text="STRING")).alias("code"), "l_linenumber")
    return _inferred(spark, coded, "code")


@query(
    "a4_infer_types_wide_ids",
    "SELECT 'decimal(38,0)' AS data_type, count(*) AS loaded_rows, CAST(0 AS BIGINT) AS rejected_rows, "
    "max(concat('9', lpad(CAST(o_orderkey AS VARCHAR), 19, '0'))) AS largest FROM orders",
)
def _infer_wide(spark, sf_dir):
    """Identifiers of twenty digits do not fit a BIGINT; none is rejected."""
    wide = F.concat(F.lit("9"), F.lpad(F.col("o_orderkey").cast("string"), 19, "0")).alias("code")
    return _inferred(spark, table(spark, sf_dir, "orders").select(wide, "o_custkey"), "code")


# Column of codes or numbers: its type, and the text of a row.
_CODES = {
    "zip": ("string", "lpad(CAST(c_custkey % 100000 AS {text}), 5, '0')"),
    "slot": ("string", "concat(CAST(c_custkey % 9 + 1 AS {text}), 'E', CAST(c_custkey % 8 AS {text}))"),
    "dial": ("string", "concat('+', CAST(c_custkey AS {text}))"),
    "size": ("string", "concat(CAST(c_custkey % 50 + 1 AS {text}), 'D')"),
    "mixed": ("string", "CASE WHEN c_custkey % 40 = 7 THEN concat('0', CAST(c_custkey AS {text})) ELSE CAST(c_custkey AS {text}) END"),
    "whole": ("bigint", "CAST(c_custkey - 20 AS {text})"),
    "ratio": ("double", "CASE WHEN c_custkey % 3 = 0 THEN '2.5E-3' WHEN c_custkey % 3 = 1 THEN '0.5' ELSE '-12' END"),
}


@query(
    "a4_infer_types_codes",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count(*) AS loaded_rows, count(DISTINCT {text.format(text='VARCHAR')}) AS different FROM customer"
        for name, (kind, text) in _CODES.items()
    ),
)
def _infer_codes(spark, sf_dir):
    """Leading zeros, exponents, plus signs and suffixes stay text, so no two codes become one."""
    path = shared_path(spark, "csv-codes")
    S.write_csv(table(spark, sf_dir, "customer").select(*[F.expr(text.format(text="STRING")).alias(name) for name, (_, text) in _CODES.items()]), path)
    text = S.read_csv_table(spark, path)
    types = Y.infer_types(text)
    ok, _ = Y.cast_or_reject(text, Y.inferred_schema(types))
    counted = ok.agg(*[F.count(c).alias(f"n_{c}") for c in _CODES], *[F.count_distinct(c).alias(f"d_{c}") for c in _CODES])
    rows = F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n_{c}").alias("loaded_rows"), F.col(f"d_{c}").alias("different")) for c in _CODES]))
    return types.select("column_name", "data_type").join(counted.select(rows), "column_name")


@query(
    "a6_sanitise_names",
    "SELECT c_custkey AS C_CUSTKEY, c_name AS FULL_NAME, c_mktsegment AS MARKET_SEGMENT FROM customer",
)
def _names(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    return Y.sanitise_names(
        customer.select("c_custkey", F.col("c_name").alias(" full name "), F.col("c_mktsegment").alias("market-segment"))
    )


_BAD = (
    "CASE WHEN o_orderkey % 50 = 3 THEN 'n/a' ELSE CAST(o_custkey AS STRING) END AS customer",
    "CASE WHEN o_orderkey % 70 = 3 THEN 'twelve' ELSE CAST(o_orderkey % 12 AS STRING) END AS month_no",
)


@query(
    "a7_cast_or_reject",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 50 <> 3 AND o_orderkey % 70 <> 3 THEN CAST(o_custkey AS VARCHAR) END AS customer, "
    "CASE WHEN o_orderkey % 50 = 3 AND o_orderkey % 70 = 3 THEN 'customer,month_no' WHEN o_orderkey % 50 = 3 THEN 'customer' "
    "WHEN o_orderkey % 70 = 3 THEN 'month_no' END AS reject_columns FROM orders",
)
def _cast(spark, sf_dir):
    text = table(spark, sf_dir, "orders").select("o_orderkey", *[F.expr(e) for e in _BAD])
    ok, rejected = Y.cast_or_reject(text, {"customer": "bigint", "month_no": "int"})
    nothing = F.lit(None)
    return ok.select(
        "o_orderkey", F.col("customer").cast("string"), nothing.cast("string").alias("reject_columns")
    ).unionByName(rejected.select("o_orderkey", nothing.cast("string").alias("customer"), "reject_columns"))


@query(
    "a8_to_number",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS amount FROM orders",
)
def _to_number(spark, sf_dir):
    text = F.when(F.col("o_orderkey") % 9 == 0, F.lit("12,5 EUR")).otherwise(F.col("o_custkey").cast("string"))
    return table(spark, sf_dir, "orders").select("o_orderkey", N.to_number(text).alias("amount"))


@query(
    "a9_to_ts",
    "SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 3 THEN strftime(o_orderdate, '%Y-%m-%d') END AS order_day FROM orders",
)
def _to_ts(spark, sf_dir):
    key, when = F.col("o_orderkey") % 4, F.col("o_orderdate")
    text = (
        F.when(key == 0, F.date_format(when, "yyyy-MM-dd"))
        .when(key == 1, F.date_format(when, "MM/dd/yyyy"))
        .when(key == 2, F.date_format(when, "yyyy-MM-dd HH:mm:ss"))
        .otherwise(F.lit("sometime soon"))
    )
    parsed = N.to_ts(text, ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "MM/dd/yyyy"])
    return table(spark, sf_dir, "orders").select("o_orderkey", F.date_format(parsed, "yyyy-MM-dd").alias("order_day"))


@query("a10_write_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _write_table(spark, sf_dir):
    path = shared_path(spark, "supplier")
    name = path.rsplit("-", 1)[-1]
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_acctbal")
    return spark.table(S.write_table(suppliers, "raw", f"supplier_{name}", path=path))


@query(
    "a11_write_csv",
    "SELECT c_mktsegment, count(*) * 2 AS rows FROM customer GROUP BY 1",
)
def _write_csv(spark, sf_dir):
    """Overwrite, then append: two copies, one header per part and none among the rows."""
    path = shared_path(spark, "customer")
    customers = table(spark, sf_dir, "customer")
    S.write_csv(customers, path, "overwrite")
    S.write_csv(customers, path, "append")
    read = S.read_csv_table(spark, path, customers.schema)
    return read.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("rows"))


@query(
    "a12_verify_counts",
    union(
        [
            f"SELECT '{t}' AS table_name, a.n AS row_count, e.n AS expected_rows, "
            f"CASE WHEN a.n = e.n THEN 'PASS' ELSE 'FAIL - unexpected count' END AS load_status "
            f"FROM (SELECT count(*) AS n FROM {t}) a, (SELECT count(*) AS n FROM {'documents' if t == 'labels' else t}) e"
            for t in TABLES
        ]
    ),
)
def _verify(spark, sf_dir):
    """Labels are expected to be as many as documents, which they are not."""
    tables = {t: table(spark, sf_dir, t) for t in TABLES}
    actual = L.table_counts(tables)
    wanted = L.table_counts({**tables, "labels": tables["documents"]})
    return L.verify_counts(actual, wanted.withColumnRenamed("row_count", "expected_rows"))


_CODED = "CASE WHEN s_suppkey % 10 = 0 THEN 'n/a' ELSE CAST(s_suppkey AS STRING) END AS code"


def _loads(spark, sf_dir):
    """Results of four loads: whole, with rejects, all rejected, and a file that is not there."""

    def job(name, df, schema=None):
        def run():
            path = shared_path(spark, f"csv-{name}")
            S.write_csv(df, path)
            store = shared_path(spark, f"load-{name}")
            return L.ingest(spark, path, "raw", f"{name}_{store.rsplit('-', 1)[-1]}", store=store, schema=schema)

        return run

    suppliers = table(spark, sf_dir, "supplier").select(F.expr(_CODED), "s_name")
    jobs = {
        "customer": job("customer", table(spark, sf_dir, "customer")),
        "supplier": job("supplier", suppliers, {"CODE": "bigint"}),
        "nation": job("nation", table(spark, sf_dir, "nation"), {"N_NAME": "bigint"}),
        "missing": lambda: L.ingest(spark, shared_path(spark, "missing"), "raw", "missing"),
    }
    return L.load_summary(spark, L.load_all(jobs))


@query(
    "a13_load_summary",
    "SELECT 'LOADED' AS status, CAST(1 AS BIGINT) AS tables, count(*) AS row_count, CAST(0 AS BIGINT) AS rejected_rows FROM customer "
    "UNION ALL SELECT 'PARTIAL', 1, count(*) FILTER (s_suppkey % 10 <> 0), count(*) FILTER (s_suppkey % 10 = 0) FROM supplier "
    "UNION ALL SELECT 'EMPTY', 1, 0, count(*) FROM nation UNION ALL SELECT 'FAILED', 1, 0, 0",
)
def _load_summary(spark, sf_dir):
    return _loads(spark, sf_dir)[1].drop("seconds")


@query(
    "h11_reconcile_ingest",
    "SELECT 'customer' AS table_name, count(*) AS expected_rows, count(*) AS loaded_rows, CAST(0 AS BIGINT) AS rejected_rows, "
    "CAST(0 AS BIGINT) AS unexplained, 'PASS' AS status FROM customer UNION ALL "
    "SELECT 'supplier', count(*), count(*) FILTER (s_suppkey % 10 <> 0), count(*) FILTER (s_suppkey % 10 = 0), 0, 'PASS' FROM supplier "
    "UNION ALL SELECT 'nation', count(*), 0, count(*), 0, 'PASS' FROM nation",
)
def _reconcile_ingest(spark, sf_dir):
    """The load results against the sources they came from."""
    results = _loads(spark, sf_dir)[0].filter("status <> 'FAILED'")
    results = results.withColumn("table_name", F.regexp_extract("table_name", r"raw\.([a-z]+)_", 1))
    expected = L.table_counts({n: table(spark, sf_dir, n) for n in ("customer", "supplier", "nation")})
    return L.reconcile_results(results, expected.withColumnRenamed("row_count", "expected_rows"))


@query(
    "a14_run",
    ctes("clean_catalog") + "SELECT row_seq, product_id, price_usd, category_l1 FROM clean_catalog",
)
def _run(spark, sf_dir):
    """One dataset and one layer out of those known."""
    tables = {n: (dirty(spark, sf_dir, n), domain(n)) for n in ("orders", "catalog")}
    frames = run(tables, datasets=["catalog"], layers=["cleaned"])
    return frames[("cleaned", "catalog")].select("row_seq", "product_id", "price_usd", "category_l1")


@query(
    "a15_head_sample",
    ctes("dirty_orders") + "SELECT row_seq, order_id, status FROM dirty_orders ORDER BY row_seq LIMIT 5",
)
def _head(spark, sf_dir):
    return S.head_sample(raw(spark, sf_dir, "orders").select("row_seq", "order_id", "status"), 5, ["row_seq"])


@query("a15_random_sample", ctes("dirty_orders") + "SELECT row_seq, order_id FROM dirty_orders WHERE row_seq * 7919 % 1000 < 100")
def _random(spark, sf_dir):
    """A tenth of the rows by key, the same tenth on every run."""
    return S.key_sample(raw(spark, sf_dir, "orders").select("row_seq", "order_id"), "row_seq", 0.1)


@query(
    "a17_write_profile",
    "SELECT 'catalog' AS table_name, (SELECT count(*) FROM part) AS total_rows, CAST(14 AS INT) AS columns, CAST(count(*) AS INT) AS recommendations FROM ("
    + decided_sql("catalog", "dirty_catalog", AS_OF, False) + ")",
)
def _profile(spark, sf_dir):
    """Profile documents and report rows written and read back."""
    name = "catalog"
    report = prepare(dirty(spark, sf_dir, name), domain(name)).report(AS_OF)
    report = materialise(report, "report")
    path = shared_path(spark, "profiles")
    L.write_profile(report, path)
    return spark.read.json(path).select(
        "profile_metadata.table_name",
        "profile_metadata.total_rows",
        F.size("column_profiles").alias("columns"),
        F.size("cleaning_recommendations").alias("recommendations"),
    )


@query(
    "a18_verify_outputs",
    "SELECT 'raw' AS namespace, 'nation' AS table_name, true AS present, true AS has_rows UNION ALL "
    "SELECT 'cleaned', 'nation', true, true UNION ALL SELECT 'profiles', 'nation', false, false",
)
def _outputs(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    mark = shared_path(spark, "nation")
    suffix = mark.rsplit("-", 1)[-1]
    for namespace in ("raw", "cleaned"):
        S.write_table(nation, namespace, f"nation_{suffix}", path=f"{mark}-{namespace}")
    checked = L.verify_outputs(spark, [(n, f"nation_{suffix}") for n in ("raw", "cleaned", "profiles")])
    return checked.withColumn("table_name", F.replace("table_name", F.lit(f"_{suffix}"), F.lit("")))
