import re
import string
from collections import Counter, defaultdict

import pytest
from helpers import as_table, rows, sql_rows
from pyspark.sql import functions as F

from burnish.llm import divergence

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def plain(data, least=10):
    """The contract, dense, in whole numbers."""
    docs = [(lang or "", source or "", re.findall(divergence.TERM, (text or "").translate(LOWER))) for _, text, lang, source, *_ in data]
    out = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        seen = Counter(t for *_, terms in own for t in set(terms))
        kept = sorted(t for t, n in seen.items() if n >= least)
        counts = defaultdict(Counter)
        for _, source, terms in own:
            counts[source].update(t for t in terms if t in set(kept))
        v = len(kept)
        share = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * v)
        gap = lambda p, q: (p - q) ** 2 // (p + q)
        everything = sum(counts.values(), Counter())
        sources = {s for _, s, _ in own}
        for s in sources:
            pairs = [(sum(gap(share(counts[s], t), share(counts[o], t)) for t in kept), o) for o in sources - {s}]
            terms = [(gap(share(counts[s], t), share(everything, t)), t) for t in kept if counts[s][t] and share(counts[s], t) > share(everything, t)]
            for part, found, most in (("pair", pairs, None), ("term", terms, 10)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, i + 1) for i, (value, item) in enumerate(found[:most])]
    return sorted(out)


def check(df, **how):
    got = divergence.audit(df, **how)
    found = sorted((r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in got.collect())
    assert found == plain([tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()], **({"least": how["least_docs"]} if how else {}))
    return got


def frame(spark, data):
    return spark.createDataFrame(data, "doc_id long, text string, lang string, source string")


def corpus(n=160, sources=7):
    """Texts with shared and own words, exact copies across sources, and repeated rows."""
    data = [(i, f"The tHe common{i % 5} word{i % 3} own{i % sources}x Éé日 {'z' * (i % 4)} {i}", "en" if i % 4 else None, f"s{i % sources}") for i in range(n)]
    data += [(1000 + i, "A copied text, a copied Text über alles", "en", f"s{i % sources}") for i in range(60)]
    return data + [data[3]] * 12 + [(7, None, "en", None), (8, "", "xx", "a"), (9, "lonely", "xx", "b")]


def test_small_table_against_sql(spark, small):
    df = spark.read.parquet(f"{small}/documents.parquet")
    assert rows(divergence.audit(df)) == sql_rows(divergence.OP13_SQL, documents=as_table(df))


def test_against_the_dense_form(spark):
    df = frame(spark, corpus())
    assert rows(check(df)) == sql_rows(divergence.OP13_SQL, documents=as_table(df))


def test_blocks_and_parts_do_not_change_the_result(spark, monkeypatch):
    for name in ("BLOCK", "SOURCES_PART", "HISTOGRAM_PART", "TALLY_ENTRIES"):
        monkeypatch.setattr(divergence, name, 2)
    check(frame(spark, corpus(sources=11)))


def test_large_lookups_are_joined(spark, monkeypatch):
    from burnish.operators import skew

    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    check(frame(spark, corpus()))


def test_awkward_rows(awkward):
    check(awkward)
    check(awkward, least_docs=1)


def test_empty(nothing):
    assert divergence.audit(nothing).count() == 0


def test_language_without_kept_terms(spark):
    got = check(frame(spark, [(i, f"word{i}", "en", f"s{i % 3}") for i in range(6)]))
    assert got.filter("part = 'pair' AND value = 0").count() == 6 == got.count()


def test_clashing_columns(spark):
    df = frame(spark, corpus(40))
    more = df.withColumns({c: F.lit("x") for c in ("h", "tag", "n", "term", "part", "item", "value", "number", "zero", "block")})
    assert rows(divergence.audit(more)) == rows(divergence.audit(df))


def test_distinct_texts_are_read_once(spark):
    """Copies leave one text each, however often the row that stands for them is repeated."""
    data = corpus()
    once, several, weights, groups = divergence.collapse(frame(spark, data))
    texts = Counter((lang or "", text or "") for _, text, lang, _ in data)
    assert once.count() == sum(n == 1 for n in texts.values())
    assert sorted((r.lang, r.text) for r in several.collect()) == sorted(k for k, n in texts.items() if n > 1)
    assert weights.agg(F.sum("n")).first()[0] == sum(n for n in texts.values() if n > 1)
    assert groups.count() == len({(lang or "", s or "") for _, _, lang, s in data})


def test_a_task_passes_on_one_row_per_term(spark, monkeypatch):
    """Twenty sources with the same words make no twenty rows of a word, and the lists are dealt out once, by term."""
    data = [(i, f"alpha Beta beta w{'x' * (i % 5)} {'abcdefghij'[i % 10] * (i // 10 + 1)}", "en", f"s{i % 20}") for i in range(100)]
    moved, write = [], divergence.materialise

    def seen(df, name):
        if name == "divergence-counts":
            plan = df._jdf.queryExecution().executedPlan()
            moved.extend(re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", re.split(r"[+:]- Union", plan.toString())[0]))
        return write(df, name)

    monkeypatch.setattr(divergence, "materialise", seen)
    counts, _ = divergence.term_counts(frame(spark, data))
    assert [re.sub(r"#\d+", "", by) for by in moved] == ["lang, term"]
    assert counts.filter("first = 1").count() == counts.select("term").distinct().count()
    found = divergence._listed(frame(spark, data).coalesce(1).select("lang", "source", "text")).collect()
    assert len(found) == len({r.term for r in found})
    assert {r.term: (r.n, r.df, len(r.counts)) for r in found}["beta"] == (200, 100, 20)
    assert all(r.n == sum(c.n for c in r.counts) and len(r.counts) == len({c.source for c in r.counts}) for r in found)


@pytest.mark.parametrize("share", [1, 3])
def test_hot_text_and_source(spark, share):
    data = [(i, "hot copy of one text" if i % 3 < share else f"text {i} of word{i % 11}", "en", "hot" if i % 2 else f"s{i % 9}") for i in range(1_500)]
    check(frame(spark, data))


def test_very_long_text(spark):
    check(frame(spark, [(1, "long word " * 30_000 + "x" * 100_000, "en", "a"), (2, "word", "en", "b")]), least_docs=1)
