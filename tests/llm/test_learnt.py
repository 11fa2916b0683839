import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from burnish.llm import ann, langid, quality
from burnish.llm.queries import QUERIES


def held(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 3 == 1


def test_language_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    found = QUERIES["op6_language_id"](spark, sf).collect()
    assert len(found) == len(truth) and all(r.held_out == held(r.doc_id) and 0 <= r.score <= 1 for r in found)
    out = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.98 * len(out)


def test_language_of_awkward_rows(spark, awkward, nothing):
    found = langid.identify(awkward.withColumn("score", F.lit("x")))
    assert found.count() == awkward.count()
    by = {r.doc_id: r for r in found.collect()}
    assert [by[i].lang_pred for i in (1, 2, 3)] == ["und"] * 3 and by[1].score == 0
    assert langid.identify(nothing).count() == 0
    kept = langid.keep_identified(awkward)
    assert kept.columns == awkward.columns and kept.count() == awkward.filter("text rlike '\\\\p{L}'").count()
    untaught = langid.identify(awkward.withColumn("lang", F.lit(None).cast("string")))
    assert {r.lang_pred for r in untaught.collect()} == {"und"}


def test_numerals_are_no_letters(spark):
    data = [(i, t, "en") for i, t in enumerate(["½", "12 ²", "① ⅳ Ⅳ", "a½b word", "words and more words"])]
    found = {r.doc_id: r.lang_pred for r in langid.identify(spark.createDataFrame(data, "doc_id long, text string, lang string")).collect()}
    assert [found[i] for i in range(5)] == ["und"] * 3 + ["en"] * 2
    assert langid._words("a½b c² c") == {"a": 1, "b": 1, "c": 2}


def test_words_first_then_shorter_grams():
    rows = lambda *x: np.log(np.array(x, np.float32))
    model = {"langs": ["aa", "bb"], "tables": [({"cat": 0}, rows([0.9, 0.1])), ({"^do": 0, "og": 1, "g$": 2, "d": 3}, rows([0.1, 0.9], [0.5, 0.5], [0.9, 0.1], [0.9, 0.1]))]}
    score = langid._scorer(model)
    assert score("cat")[0] == "aa" and score("cat cat dog")[0] == "aa"
    assert score("dog")[0] == "bb"  # its longest known n-gram is ^do
    assert score("d")[0] == "aa" and score("zzz") == ("aa", 0.5) and score("12 ..") == ("und", 0.0)
    alone, again = langid._scorer(model)("dog")[1], score("dog")[1]
    assert alone == again


def test_quality_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    found = QUERIES["op9_quality_votes"](spark, sf).collect()
    assert len(found) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    out = [r for r in found if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in out) >= 0.93 * len(out)


def test_quality_votes_against_all_pairs(spark):
    docs = spark.createDataFrame([(i, ("good words here " if i % 2 else "### bad %%% ") * (1 + i % 5) + str(i)) for i in range(80)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)] + [(1, None)], "doc_id long, quality int")
    learnt = [i for i in range(80) if not held(i)]
    model = quality.fit(docs, labels.filter(F.col("doc_id").isin(learnt)).withColumnRenamed("quality", "label"))
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    vectors = quality._project(texts, model["space"])
    for i, got in enumerate(quality.votes(texts, model, 5)):
        similar = np.maximum(vectors[learnt] @ vectors[i], 0)
        similar = np.round(similar.astype(np.float64), quality.ROUNDED)
        near = sorted(range(len(learnt)), key=lambda j: (-similar[j], j))[:5]
        want = sum(similar[j] * (learnt[j] % 2) for j in near) / sum(similar[j] for j in near)
        assert got == pytest.approx(want, abs=1e-4)
    found = {r.doc_id: r for r in quality.score(docs, labels).collect()}
    assert sum(found[i].predicted == i % 2 for i in range(80) if held(i)) >= 0.95 * sum(held(i) for i in range(80))


def test_equal_similarities_go_to_the_first():
    similar = np.array([[0.5, 0.9, 0.5, 0.5, 0.1], [0.0, 0.0, 0.0, 0.0, 0.0], [0.1, 0.2, 0.3, 0.4, 0.5]])
    assert quality._nearest(similar, 3).tolist() == [[0, 1, 2], [0, 1, 2], [2, 3, 4]]
    drawn = np.random.default_rng(3).integers(0, 4, (200, 30)) / 4
    want = [sorted(sorted(range(30), key=lambda j: (-row[j], j))[:7]) for row in drawn]
    assert quality._nearest(drawn, 7).tolist() == want


def test_quality_of_awkward_rows(spark, awkward, nothing):
    labels = spark.createDataFrame([(4, 1), (4, 0), (5, 1), (None, 1), (6, 0), (99, 1)], "doc_id long, quality int")
    found = quality.score(awkward, labels)
    assert found.count() == awkward.count() and all(0 <= r.score <= 1 for r in found.collect())
    assert {r.score for r in quality.score(awkward, labels.limit(0)).collect()} == {0.5}
    assert quality.score(nothing, labels).count() == 0


def exact(data, k):
    """vec_id -> the k best others, by sorting all of them."""
    ids, x = [i for i, _ in data], np.array([v for _, v in data], np.float64)
    return {q: [(ids[j], float(x[a] @ x[j])) for j in sorted((j for j in range(len(ids)) if ids[j] != q), key=lambda j: (-float(x[a] @ x[j]), ids[j]))[:k]] for a, q in enumerate(ids)}


def test_search_recall(spark):
    sf = "/root/testdata/sf0.01"
    data = sorted((r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect())
    want = exact(data, 20)
    got = {}
    for r in QUERIES["op5_nearest_vectors"](spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {i for i, _ in data if i % 20 == 0}
    for q, rows in got.items():
        assert [r[0] for r in sorted(rows)] == list(range(1, 21)) and [-r[2] for r in sorted(rows)] == sorted(-r[2] for r in rows)
    recall = np.mean([len({r[1] for r in rows} & {i for i, _ in want[q]}) / 20 for q, rows in got.items()])
    assert recall >= 0.9


@pytest.mark.parametrize("asked, turn", [(20_000, 1_000), (2, 1)])
def test_search_with_copies_and_bad_vectors(spark, monkeypatch, asked, turn):
    monkeypatch.setattr(ann, "ASKED", asked)  # a task's queries: all, or two in turns of one
    monkeypatch.setattr(ann, "TURN", turn)
    rng = np.random.default_rng(4)
    data = [(i, [float(x) for x in rng.normal(size=4).astype(np.float32)]) for i in range(60)]
    data += [(i, [1.0, 2.0, 3.0, 4.0]) for i in range(100, 160)]  # a large class of copies
    bad = [(200, None), (201, [0.0] * 4), (202, [1.0, None, 1.0, 1.0]), (203, [float("nan")] * 4), (204, [float("inf"), 1.0, 1.0, 1.0]), (205, []), (206, [1.0] * 3), (None, [1.0] * 4), (0, data[0][1])]
    df = spark.createDataFrame(data + bad, "vec_id long, embedding array<float>")
    want = exact(data, 5)
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=5, lists=6, recall=1.0, block=7).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == {0, 20, 40, 100, 120, 140}
    for q, rows in got.items():
        assert [r[1] for r in sorted(rows)] == [i for i, _ in want[q]]
        assert np.allclose([r[2] for r in sorted(rows)], [s for _, s in want[q]])


def test_beam_widens_until_the_ratio_ends_it():
    points = np.random.default_rng(5).normal(size=(400, 8)).astype(np.float32)
    index = ann.build(points, 40, float(np.linalg.norm(points, axis=1).max()), 5)
    aims = ann._aim(points[:30], index["longest"])
    gaps = np.sqrt(ann._gaps(aims, index["centres"]))
    want = [set(np.flatnonzero(g <= 3 * g.min() + 1e-6)) for g in gaps]
    assert max(map(len, want)) > 4
    got = ann.lists_within(aims, {**index, "beam": 4}, 3)
    assert [set(x) for x in got] == want


def test_search_of_few_rows(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema), F.col("vec_id") % 20 == 0).count() == 0
    assert ann.search(spark.createDataFrame([(0, [1.0])], schema), F.col("vec_id") % 20 == 0).count() == 0
    few = spark.createDataFrame([(i, [float(i + 1), 1.0]) for i in range(3)], schema)
    assert [r.vec_id for r in ann.search(few, F.col("vec_id") % 20 == 0).orderBy("rank").collect()] == [2, 1]


def test_lists_cut_short_are_searched_exactly(spark):
    rng = np.random.default_rng(9)
    data = [(i, [float(x) for x in rng.normal(size=8)]) for i in range(100)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    found = ann.search(df, F.col("vec_id") % 20 == 0, k=20, lists=60, recall=0.0)
    assert found.groupBy("query_id").count().filter("count <> 20").count() == 0


def test_ratio_is_measured_on_neighbours_in_the_whole_table(spark, monkeypatch):
    """Neighbours among the sample alone are farther away, and sample vectors lie nearer to their list: nearly all lists were read."""
    monkeypatch.setattr(ann, "SAMPLE", 600)
    monkeypatch.setattr(ann, "SHARD_BYTES", 100_000)
    built = []
    build = ann.build
    monkeypatch.setattr(ann, "build", lambda *a, **b: built.append(build(*a, **b)) or built[-1])
    rng = np.random.default_rng(8)
    x = rng.normal(size=(8_000, 24)).astype(np.float32)
    x[4_000:4_020] = x[7]  # copies
    data = [(i, [float(y) for y in v]) for i, v in enumerate(x)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    got = {}
    for r in ann.search(df, F.col("vec_id") % 20 == 0, k=10, lists=80).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(range(0, 8_000, 20))
    scores = x[::20].astype(np.float64) @ x.astype(np.float64).T
    scores[np.arange(400), np.arange(0, 8_000, 20)] = -np.inf
    ids = np.broadcast_to(np.arange(8_000), scores.shape)
    want = np.lexsort((ids, -scores))[:, :10]
    for q, rows in got.items():
        assert [r[0] for r in sorted(rows)] == list(range(1, 11))
        assert [(-r[2], r[1]) for r in sorted(rows)] == sorted((-r[2], r[1]) for r in rows)
        assert np.allclose([r[2] for r in rows], [scores[q // 20, r[1]] for r in rows], rtol=0, atol=1e-9)
    assert np.mean([len({r[1] for r in got[20 * i]} & set(w.tolist())) / 10 for i, w in enumerate(want)]) >= 0.95
    gaps = np.sqrt(ann._gaps(ann._aim(x[::20], built[0]["longest"]), built[0]["centres"]))
    assert (gaps <= built[0]["ratio"] * gaps.min(axis=1, keepdims=True)).mean() < 0.8


@pytest.mark.parametrize("kind, scale", [(np.float32, 1.0), (np.float64, 1.0), (np.float64, 1e200), (np.float64, 1e-200), (np.float32, 1e37)])
def test_products_in_single_precision_leave_out_none_of_the_best(monkeypatch, kind, scale):
    monkeypatch.setattr(ann, "PENDING", 3)
    rng = np.random.default_rng(10)
    x = np.concatenate((rng.normal(size=(600, 12)), rng.integers(-1, 2, (600, 12)) + 1e-9 * rng.normal(size=(600, 12))))
    x = (x * scale).astype(kind)
    counts = rng.integers(1, 4, len(x))
    lists = np.concatenate([rng.choice(9, n, replace=False) for n in counts]).astype(np.int32)
    held = [set(y.tolist()) for y in np.split(lists, np.cumsum(counts)[:-1])]
    cids = rng.permutation(len(x)) + 5
    shard = ann._Shard(cids, x, counts, lists)
    queries = np.concatenate((rng.normal(size=(20, 12)), rng.integers(-1, 2, (20, 12)) + 0.5)).astype(kind)
    read = rng.random((9, 40)) < 0.4
    read[:, 3] = False
    place, cid, score = shard.best(queries, read, 7, 50)
    for q in range(40):
        can = [i for i in range(len(x)) if any(read[j, q] for j in held[i])]
        true = np.einsum("ij,ij->i", np.broadcast_to(queries[q].astype(np.float64), x[can].shape), x[can].astype(np.float64)) if can else []
        best = sorted(zip(-np.asarray(true), cids[can]))[:7]
        assert [(s, c) for s, c in zip(-score[place == q], cid[place == q])] == best


def test_few_queries_are_searched_where_the_rows_lie(spark, monkeypatch):
    data = [(i, [float(i % 7), 1.0 + i % 3]) for i in range(50)]
    rows = spark.createDataFrame(data, "cid long, v array<float>").repartition(4)
    asked = rows.filter("cid < 4").selectExpr("cid AS query_id", "v AS q", "cid")
    want = exact(data, 60)
    found = []
    for few in (4, 3):  # in place, and by shards
        monkeypatch.setattr(ann, "FEW", few)
        found.append(sorted(map(tuple, ann._exact(rows, asked, {"n": 50, "d": 2}, 6, 5).collect())))
    assert found[0] == found[1] and len(found[0]) == 24
    for q in range(4):
        all_rows = sorted([*want[q], (q, float(np.dot(data[q][1], data[q][1])))], key=lambda x: (-x[1], x[0]))[:6]
        assert sorted((c, s) for i, c, s in found[0] if i == q) == sorted(all_rows)


def test_centroid_graph_finds_the_nearest_lists():
    rng = np.random.default_rng(6)
    index = ann.build(rng.normal(size=(4000, 16)).astype(np.float32), 100, 10.0, 10)
    for points, most, share in ((ann._lift(rng.normal(size=(50, 16)), 10.0), 4, 0.95), (ann._aim(rng.normal(size=(50, 16)), 10.0), 20, 0.85)):
        nodes, gaps = ann.nearest_lists(points, index, most)
        true = np.sort(np.sqrt(ann._gaps(points, index["centres"])), axis=1)[:, :most]
        assert (np.abs(gaps - true) < 1e-3).mean() > share and all(len(set(n)) == len(n) for n in nodes.tolist())


def test_no_language_is_crowded_out(spark):
    def word(lang, k):
        return "".join(chr(97 + x) for x in (lang // 26, lang % 26, k // 26, k % 26))

    # 100 languages of 60 words each; the last has 6 documents beside others with 30.
    data = [(f"l{lang:02d}", " ".join(word(lang, (7 * d + k) % 60) for k in range(10))) for lang in range(100) for d in range(6 if lang == 99 else 30)]
    rows = spark.createDataFrame([(i, text, lang) for i, (lang, text) in enumerate(data)], "doc_id long, text string, lang string")
    model = langid.learn(rows, cells=4_000)
    known = model["tables"][0][0]
    assert all(w in known for _, text in data for w in text.split())
    score = langid._scorer(model)
    last = [score(text)[0] for lang, text in data if lang == "l99"]
    assert last == ["l99"] * len(last)


def test_each_language_keeps_its_most_frequent_grams(spark):
    counts = [("big", f"b{i}", 1000 + i) for i in range(200)] + [("small", f"s{i}", 1 + i) for i in range(30)] + [("small", "b199", 40)]
    top = langid._top(spark.createDataFrame(counts, "lang string, gram string, n long"), 10).collect()
    assert {(r.lang, r.gram) for r in top} == {("big", f"b{i}") for i in range(190, 200)} | {("small", f"s{i}") for i in range(21, 30)} | {("small", "b199")}


def test_tables_read_alike_spread_out_or_not(monkeypatch):
    rows = (np.array([-9, -8, -7], np.float32), np.array([0, 2, 2, 3]), np.array([0, 2, 1], np.int32), np.array([-1, -2, -3], np.float32))
    plain = langid._reader(rows)([0, 1, 2])
    model = {"langs": ["a", "b", "c"], "tables": [({"x": 0, "y": 1, "z": 2}, rows), ({"q": 2}, rows)]}
    scored = [langid._scorer(model)(t) for t in ("x z", "q", "y", "x q")]
    monkeypatch.setattr(langid, "SPREAD", 0)
    assert (langid._reader(rows)([0, 1, 2]) == plain).all() and plain.tolist() == [[-1, -8, -2], [-9, -8, -7], [-9, -3, -7]]
    assert [langid._scorer(model)(t) for t in ("x z", "q", "y", "x q")] == scored
