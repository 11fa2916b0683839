import numpy as np
from helpers import as_table, rows, sql_rows
from pyspark.sql import functions as F

from burnish.llm import decontaminate as dc
from burnish.llm.queries import QUERIES

BENCH = "item_id long, text string"


def digest(docs, bench, **options):
    found = dc.judged(dc.mark(docs, bench, **options))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"), F.sha2(F.concat_ws(",", F.array_sort("hit_items")), 256).alias("items_sha256"), "contaminated")


def test_small_table(spark, small):
    docs, bench = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "benchmark"))
    want = sql_rows(dc.OP7_SQL, documents=as_table(docs), benchmark=as_table(bench))
    assert rows(QUERIES["op7_decontaminate"](spark, small)) == want
    assert rows(digest(docs, bench, block_words=300)) == want


def test_awkward_rows(spark, awkward):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "two THREE"), (3, "four"), (None, "id at all"), (5, "word " * 20), (6, " ".join(f"w{i}" for i in range(5000))), (7, "ü")], BENCH)
    more = spark.createDataFrame([(20, " ".join(f"w{i}" for i in range(4990, 5000))), (21, "x " + " ".join(f"W{i}," for i in range(1980, 2010)))], "doc_id long, text string")
    docs = awkward.select("doc_id", "text").unionAll(more)
    known = bench.filter("item_id IS NOT NULL")
    assert rows(digest(docs, known)) == sql_rows(dc.OP7_SQL, documents=as_table(docs), benchmark=as_table(known))
    found = {r.doc_id: r for r in dc.mark(docs, bench).collect()}
    assert found[None].hit_items in (["null"], []) and found[21].hit_items == ["6"]
    start, end = map(int, found[21].spans.split(":"))
    assert found[21].text[start:end].startswith("W1980") and found[21].text[start:end].endswith("W2009")


def test_empty_tables(spark, awkward, nothing):
    none = spark.createDataFrame([], BENCH)
    assert rows(digest(awkward, none)) == sql_rows(dc.OP7_SQL, documents=as_table(awkward), benchmark=as_table(none))
    assert digest(nothing, spark.createDataFrame([(1, "a b")], BENCH)).count() == 0
    assert dc.drop_contaminated(awkward, none).count() == awkward.count()


def test_clashing_columns(spark, awkward):
    extra = awkward.withColumn("spans", F.lit(1)).withColumn("n_hit", F.lit(2))
    assert dict(dc.mark(extra, spark.createDataFrame([(1, "two three")], BENCH)).dtypes)["spans"] == "string"


def test_index_against_plain_search():
    rng = np.random.default_rng(5)
    text = np.append(rng.integers(1, 6, 400), 0)
    text[100:180] = text[200:280]
    index = dc.FMIndex(text)
    lengths = rng.integers(1, 8, 200)
    patterns = np.zeros((200, 8), np.int64)
    for i, n in enumerate(lengths):
        patterns[i, 8 - n :] = rng.integers(1, 9, n) if i % 2 else text[(at := rng.integers(0, 390)) : at + n]
    lengths = (np.cumsum(patterns > 0, axis=1).max(axis=1)).astype(np.int64)
    which, start, end = index.find(patterns, lengths)
    found = dict(zip(which.tolist(), zip(start, end)))
    for i in range(200):
        want = [] if (patterns[i, 8 - lengths[i] :] == 0).any() else [p for p in range(400 - lengths[i] + 1) if (text[p : p + lengths[i]] == patterns[i, 8 - lengths[i] :]).all()]
        got = sorted(index.locate(np.array([found[i][0]]), np.array([found[i][1]])).tolist()) if i in found else []
        assert got == want
