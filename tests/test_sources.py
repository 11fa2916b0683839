"""Files, types, rejects, loads."""

import pytest
from pyspark.sql import functions as F

from burnish.operators.detect import invalid_utf8
from burnish.operators.language import guess_language, wrong_language
from burnish.session import shared_dir, shared_path
from burnish.sources.files import CORRUPT, normalise_null_tokens, read_csv_table, write_csv
from burnish.sources.load import ingest, load_all, load_summary
from burnish.sources.typing import (
    cast_or_reject,
    infer_types,
    inferred_schema,
    is_temporal_name,
    reject_counts,
    sanitise_names,
)


@pytest.mark.parametrize("name", ["created_at", "updated_at", "order_date", "timestamp_utc", "hire_date", "go_live_date"])
def test_temporal_names(name):
    assert is_temporal_name(name)


@pytest.mark.parametrize(
    "name", ["customer_attr_1", "emp_attr_5", "price_attr_10", "compliance_attr_33", "order_date_flag", "status"]
)
def test_names_that_only_look_temporal(name):
    assert not is_temporal_name(name)


def test_inference_needs_evidence(spark):
    rows = [(str(i), f"2024-01-{i % 28 + 1:02d}", "7", "x", f"{i}.5", None, 2.0, 2.5) for i in range(50)]
    df = spark.createDataFrame(
        rows,
        "n string, order_date string, lead_time_days string, note_date string, price string, empty string, whole double, part double",
    )
    got = inferred_schema(infer_types(df))
    assert got == {
        "n": "bigint", "order_date": "timestamp_ntz", "lead_time_days": "bigint", "note_date": "string",
        "price": "double", "empty": "string", "whole": "bigint", "part": "double",
    }


def test_inference_reads_every_row(spark):
    late = spark.range(10_500).selectExpr("CAST(id AS STRING) AS code").unionAll(spark.range(1_500).selectExpr("concat('C', id) AS code"))
    assert inferred_schema(infer_types(late)) == {"code": "string"}
    wide = spark.createDataFrame([("9" * 20, "9" * 40, "2024-01-01", "9" * 18), ("1", "2", "soon", "3")], "a string, b string, order_date string, c string")
    assert inferred_schema(infer_types(wide)) == {"a": "decimal(38,0)", "b": "string", "order_date": "string", "c": "bigint"}
    far = spark.createDataFrame([(1e19,), (2.0,)], "v double")
    assert inferred_schema(infer_types(far)) == {"v": "double"}


def test_ingest_keeps_and_counts_rejects(spark, tmp_path):
    path = str(tmp_path / "in")
    write_csv(spark.range(30).selectExpr("id", "CASE WHEN id % 10 = 0 THEN 'n/a' ELSE CAST(id AS STRING) END AS code"), path)
    loaded, rejects, result = ingest(spark, path, "raw", "ingest_test", store=str(tmp_path / "t"), schema={"CODE": "bigint"})
    assert result[1:3] == (27, 3) and result[4] == "PARTIAL" and loaded.count() == 27
    assert {r["ID"] for r in rejects.collect()} == {"0", "10", "20"}
    _, _, result = ingest(spark, path, "raw", "ingest_whole", store=str(tmp_path / "w"))
    assert result[1:3] == (30, 0) and result[4] == "LOADED"


def test_csv_round_trip_with_quotes(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, "plain"), (3, None)], "id int, note string")
    path = str(tmp_path / "t")
    write_csv(df, path)
    read = read_csv_table(spark, path)
    assert read.columns == ["id", "note"] and dict(read.dtypes) == {"id": "string", "note": "string"}
    assert sorted(r["note"] or "" for r in read.collect()) == ["", "plain", 'say "hi", ok']
    write_csv(df, path, "append")
    assert read_csv_table(spark, path).count() == 6


def test_ragged_rows(spark, tmp_path):
    path = tmp_path / "ragged.csv"
    path.write_text("a,b,c\n1,2,3\n4,5\n6,7,8,9\n")
    rows = {r["a"]: r for r in read_csv_table(spark, str(path), permissive=True).collect()}
    assert rows["4"]["c"] is None and rows["4"][CORRUPT] == "4,5"
    assert rows["6"]["c"] == "8" and rows["6"][CORRUPT] == "6,7,8,9"
    assert rows["1"][CORRUPT] is None


def test_null_tokens_and_names(spark):
    df = spark.createDataFrame([("", 1), ("NaT", 2), ("None", 3), ("nan", 4), ("Nancy", 5)], "`my-col` string, n int")
    out = sanitise_names(normalise_null_tokens(df))
    assert out.columns == ["MY_COL", "N"]
    assert [r["MY_COL"] for r in out.orderBy("N").collect()] == [None, None, None, None, "Nancy"]
    numbers = spark.createDataFrame([(float("nan"),), (1.0,), (None,)], "v double")
    assert normalise_null_tokens(numbers).agg(F.count("v")).first()[0] == 1


def test_rejects_keep_the_row_and_the_reason(spark):
    df = spark.createDataFrame([("1", "2.5"), ("x", "2.5"), ("y", "z"), (None, "1")], "a string, b string")
    ok, bad = cast_or_reject(df, {"a": "bigint", "b": "double"})
    assert [tuple(r) for r in ok.collect()] == [(1, 2.5), (None, 1.0)]
    assert {r["a"]: r["reject_columns"] for r in bad.collect()} == {"x": "a", "y": "a,b"}
    assert {r["reject_columns"]: r["rejected_rows"] for r in reject_counts(bad).collect()} == {"a": 1, "a,b": 1}


def test_one_failed_load_does_not_stop_the_rest(spark):
    def good():
        return None, None, ("raw.t", 5, 2, 0.1, "PARTIAL", None)

    def bad():
        raise RuntimeError("no file" * 200)

    frame, totals = load_summary(spark, load_all({"bad": bad, "good": good}))
    assert {r["status"]: (r["row_count"], r["rejected_rows"]) for r in totals.collect()} == {"PARTIAL": (5, 2), "FAILED": (0, 0)}
    assert frame.filter("status = 'FAILED'").first()["error"] == "no file" * 200


def test_shared_folder_comes_from_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is not None:
        assert shared_dir(spark) == named.rstrip("/")
    assert shared_path(spark, "x").startswith(f"{shared_dir(spark)}/x-")
    assert shared_path(spark, "x") != shared_path(spark, "x")


def test_languages(spark):
    rows = [
        ("en", "the cat and the dog are in that house", False),
        ("fr", "the cat and the dog are in that house", True),
        ("fr", "le chat est dans une maison et elle dort", False),
        ("de", "der Hund und die Katze ist nicht mit den anderen", False),
        ("es", "el perro y los gatos con una casa para del al", False),
        ("hi", "उत्पाद का नाम", False),
        ("hi", "商品の名前", True),
        ("ja", "商品の名前", False),
        ("ja", "12345", False),
        ("en", None, False),
        ("en", "zzz qqq", False),
    ]
    df = spark.createDataFrame(rows, "lang string, t string, want boolean")
    got = df.select("lang", "t", "want", wrong_language(F.col("t"), F.col("lang")).alias("got"))
    assert got.filter("got <> want").collect() == []
    assert df.filter("t = 'zzz qqq'").select(guess_language(F.col("t"))).first()[0] is None


def test_binary_that_is_not_utf8(spark):
    df = spark.sql("SELECT X'C328' AS b UNION ALL SELECT X'6869'")
    assert df.filter(invalid_utf8(F.col("b"))).count() == 1


def test_stored_reports_answer_by_path(spark):
    from burnish.session import materialise
    from burnish.sources import load as L

    texts = ['{"a": {"n": 3}, "rows": [{"c": "x", "v": 1}, {"c": "y"}]}', '{"a": {"n": "three"}, "rows": []}', "no json", None]
    report = spark.createDataFrame(list(enumerate(texts)), "table_name int, full_profile_json string")
    stored = materialise(L.as_variant(report), "report")
    assert stored.schema["full_profile_json"].dataType.simpleString() == "variant"
    values = {"n": ("$.a.n", "bigint"), "none": ("$.a.x.y", "string")}
    found = stored.select("table_name", *L.document_values(values)).orderBy("table_name").collect()
    assert [(r.n, r.none) for r in found] == [(3, None), (None, None), (None, None), (None, None)]
    rows = L.document_rows(stored, "$.rows", {"c": ("$.c", "string"), "v": ("$.v", "bigint")}).collect()
    assert sorted((r.table_name, r.c, r.v) for r in rows) == [(0, "x", 1), (0, "y", None)]
