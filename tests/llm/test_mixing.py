from helpers import as_table, rows, sql_rows
from pyspark.sql import functions as F

from burnish.llm import mixing

OUT = ["doc_id", "size", "source_size", "target", "taken"]


def check(df):
    found = mixing.mix(df)
    assert rows(found.select(*OUT)) == sql_rows(mixing.OP8_SQL, documents=as_table(df))
    return found


def test_small_table(spark, small):
    check(spark.read.parquet(f"{small}/documents.parquet"))


def test_awkward_rows(awkward):
    found = check(awkward)
    assert found.count() == awkward.count()
    assert found.columns == [*awkward.columns, *OUT[1:]]


def test_empty(nothing):
    assert mixing.mix(nothing).count() == 0


def test_buckets_do_not_change_the_result(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    assert rows(mixing.mix(docs, bucket_rows=3).select(*OUT)) == rows(mixing.mix(docs, bucket_rows=10**9).select(*OUT))


def test_budgets_are_met(spark, small):
    found = mixing.mix(spark.read.parquet(f"{small}/documents.parquet"))
    for r in found.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g"), F.max(F.col("taken") - 2 * F.col("size")).alias("over")).collect():
        assert r.t == int(r.g) and r.over <= 0


def test_clashing_columns_are_replaced(awkward):
    found = mixing.mix(awkward.withColumn("size", F.lit("x")).withColumn("_key", F.lit(1)).withColumn("taken", F.lit("y")))
    assert dict(found.dtypes)["size"] == "bigint" and "_key" in found.columns


def test_one_source_only(spark):
    df = spark.createDataFrame([(i, "a b c", "s") for i in range(9)], "doc_id long, text string, source string")
    found = mixing.mix(df)
    assert found.agg(F.sum("taken")).first()[0] == int(1.5 * 27)


def test_offsets_over_many_blocks(spark):
    """Buckets far apart, so both levels of the prefix sum are used."""
    sums = [(name, 997 * i, i % 7) for name in ("=a", "") for i in range(50)]
    found = mixing.bucket_offsets(spark.createDataFrame(sums, "_name string, _bucket long, _sum long"))
    earlier = sorted((name, at, sum(s for n, b, s in sums if n == name and b < at)) for name, at, _ in sums)
    assert sorted((r._name, r._bucket, r._offset) for r in found.collect()) == earlier


def test_hot_source_is_cut_like_small_ones(spark):
    rows_ = [(i, "a b", "hot" if i % 3 else f"s{i % 30}") for i in range(6_000)]
    df = spark.createDataFrame(rows_, "doc_id long, text string, source string")
    assert check(df).count() == len(rows_)
