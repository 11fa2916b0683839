"""Source divergence audit over distinct texts.

For every language the audit compares the term distributions of its sources.  Identical texts
of a language are collapsed first: a narrow pass over hashes (SHA-256) finds the texts that
occur more than once, their multiplicity in each source and one row to stand for them.
Every distinct text is tokenised once, in Arrow batches; its term counts and document frequencies
are added up within a task and weighted by the multiplicities.  Texts stay where they are read.
A task passes on one row per language and term, with the list of its sources; the lists are dealt
by term once, and opened only for terms that are kept.

Pairs are evaluated sparsely.  With smoothed shares p and q, a pair's distance sums
f = floor((p - q)^2 / (p + q)) over all kept terms of the language, but a term that one side
lacks has that side's fixed share.  So only terms that both sides have are joined; those of
one side come from a histogram of its counts, those of neither from their number.  The join
of shared terms is dealt by term and by blocks of sources, so a term of all sources is no hot
key, and the two directions of a pair are computed once.

All arithmetic is in integers.  Defined cases: null texts, languages and sources are empty
strings; repeated rows count each; a language without kept terms has distances 0 and no
terms; an empty table gives an empty result; further columns are ignored, whatever their
names; texts are read whole.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnish.llm.common import small_batches
from burnish.operators.skew import attach
from burnish.session import materialise

TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
LEAST_DOCS = 10
SCALE = 1_000_000_000
TOP = 10
BLOCK = 256  # sources of a block
SOURCES_PART = 1024  # sources of one copied text that are weighted together
HISTOGRAM_PART = 4096
TALLY_ENTRIES = 1 << 20  # terms that a task counts before it passes them on


def _whole(docs: DataFrame) -> DataFrame:
    plain = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = docs.select(plain("lang").alias("lang"), plain("source").alias("source"), plain("text").alias("text"), F.xxhash64("doc_id").alias("tag"))
    return rows.withColumn("h", F.unhex(F.sha2("text", 256)))


def _words(batches, names: list[str]):
    """(keys, words) of every row of (names.., text) that has words.

    In UTF-8 a term is a run of ASCII letters and of bytes from 128 on, so every other byte
    becomes a space, capitals their small letters, and the rest is a split.
    """
    import pyarrow as pa

    table = bytes(x + 32 if 65 <= x <= 90 else x if 97 <= x <= 122 or x > 127 else 32 for x in range(256))
    for batch in batches:
        keys = zip(*[batch.column(n).to_pylist() for n in names])
        for key, text in zip(keys, batch.column("text").cast(pa.binary())):
            if words := text.as_py().translate(table).split():
                yield key, words


def _tallies(kinds: list[tuple[str, str]], entries: int):
    """Counts the terms of (keys.., text) rows; a task's tallies go out when they reach ``entries`` terms."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        types = [pa.string() if t == "string" else pa.int64() for _, t in kinds]
        names = [n for n, _ in kinds]
        tallies, held = {}, 0

        def out():
            for key, n in tallies.items():
                terms = list(n)
                for at in range(0, len(terms), 100_000):
                    some = terms[at : at + 100_000]
                    columns = [pa.repeat(pa.scalar(k, t), len(some)) for k, t in zip(key, types)]
                    columns.append(pa.array(some, pa.binary()).view(pa.string()))
                    columns.append(pa.array(map(n.__getitem__, some), pa.int64()))
                    yield pa.RecordBatch.from_arrays(columns, [*names, "term", "tf"])

        for key, words in _words(batches, names):
            n = tallies.setdefault(key, Counter())
            before = len(n)
            n.update(words)
            held += len(n) - before
            if held >= entries:
                yield from out()
                tallies, held = {}, 0
        yield from out()

    return run


def _lists(entries: int):
    """Counts the terms of (lang, source, text) rows; a task's lists go out when they reach ``entries`` terms of sources."""

    def run(batches):
        from collections import Counter

        import numpy as np
        import pyarrow as pa

        langs, held = {}, 0

        def out():
            for lang, (df, sources) in langs.items():
                place = {term: at for at, term in enumerate(df)}
                lengths = [len(n) for n in sources.values()]
                at = np.concatenate([np.fromiter(map(place.__getitem__, n), np.int64, len(n)) for n in sources.values()])
                order = np.argsort(at, kind="stable")
                counts = np.concatenate([np.fromiter(n.values(), np.int64, len(n)) for n in sources.values()])[order]
                names = pa.array(sources, pa.string()).take(pa.array(np.repeat(np.arange(len(lengths)), lengths)[order]))
                ends = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(df)))])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([names, pa.array(counts)], ["source", "n"]))
                columns = [pa.array(df, pa.binary()).view(pa.string()), pa.array(np.add.reduceat(counts, ends[:-1])), pa.array(df.values(), pa.int64()), lists]
                whole = pa.RecordBatch.from_arrays([pa.repeat(pa.scalar(lang, pa.string()), len(df)), *columns], ["lang", "term", "n", "df", "counts"])
                for start in range(0, len(df), 10_000):
                    yield whole.slice(start, 10_000)

        for (lang, source), words in _words(batches, ["lang", "source"]):
            df, sources = langs.setdefault(lang, (Counter(), {}))
            n = sources.setdefault(source, Counter())
            before = len(n)
            n.update(words)
            df.update(set(words))
            held += len(n) - before
            if held >= entries:
                yield from out()
                langs, held = {}, 0
        yield from out()

    return run


def _tallied(texts: DataFrame, keys: list[str]) -> DataFrame:
    """(keys.., text) -> (keys.., term, tf): tokens, added up within a task."""
    kinds = [(k, dict(texts.dtypes)[k]) for k in keys]
    schema = ", ".join(f"{k} {t}" for k, t in [*kinds, ("term", "string"), ("tf", "bigint")])
    return small_batches(texts.select(*keys, "text")).mapInArrow(_tallies(kinds, TALLY_ENTRIES), schema)


def _listed(texts: DataFrame) -> DataFrame:
    """(lang, source, text) -> (lang, term, n, df, counts): tokens, texts with the term and tokens of each source, added up within a task."""
    schema = "lang string, term string, n bigint, df bigint, counts array<struct<source: string, n: bigint>>"
    return small_batches(texts.select("lang", "source", "text")).mapInArrow(_lists(TALLY_ENTRIES), schema)


def collapse(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(once, several, weights, groups).

    ``once``: texts that occur once in their language, with their source.  ``several``: each
    copied text once, with a number and into how many parts its sources are dealt.
    ``weights``: the sources of the copied texts and how often each has them.  ``groups``: all
    (lang, source).  A copied text is read from one of its rows, chosen by source and id; where
    that very row is repeated, the repeats are dropped after a map-side collapse.
    """
    whole = _whole(docs)
    held = materialise(whole.groupBy("lang", "h", "source", "tag").agg(F.count(F.lit(1)).alias("n")), "divergence-hashes")
    per = held.groupBy("lang", "h", "source").agg(F.sum("n").alias("n"), F.min(F.struct("tag", "n")).alias("first"))
    copied = per.groupBy("lang", "h").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("s"), F.min(F.struct("source", "first")).alias("rep")).filter("n > 1")
    copied = copied.select(
        "lang",
        "h",
        F.monotonically_increasing_id().alias("number"),
        F.ceil(F.col("s") / SOURCES_PART).cast("long").alias("parts"),
        F.col("rep.source").alias("_source"),
        F.col("rep.first.tag").alias("_tag"),
        F.col("rep.first.n").alias("_n"),
    )
    copied = materialise(copied, "divergence-copied")
    marked = attach(whole, copied, ["lang", "h"])
    once = marked.filter(F.col("number").isNull()).select("lang", "source", "text")
    stands = marked.filter((F.col("source") == F.col("_source")) & (F.col("tag") == F.col("_tag")))
    text = ["lang", "number", "parts", "text"]
    several = stands.filter("_n = 1").select(*text).unionByName(stands.filter("_n > 1").select(*text).distinct())
    weights = per.select("lang", "h", "source", "n").join(copied.select("lang", "h", "number", "parts"), ["lang", "h"])
    return once, several, weights.drop("lang", "h"), held.select("lang", "source").distinct()


def term_counts(docs: DataFrame, least_docs: int = LEAST_DOCS) -> tuple[DataFrame, DataFrame]:
    """(counts, groups): (lang, source, term, n, lang_n, first) of the kept terms, and all (lang, source).

    ``first`` is 1 on one row of each (lang, term).
    """
    once, several, weights, groups = collapse(docs)
    copied = _tallied(several, ["lang", "number", "parts"])
    copied = copied.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    dealt = weights.select("number", "source", F.col("n").alias("copies"), F.pmod(F.xxhash64("source"), F.col("parts")).alias("part"))
    copied = copied.join(dealt, ["number", "part"]).select("lang", "source", "term", (F.col("tf") * F.col("copies")).alias("n"), "copies")
    copied = copied.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("copies").alias("df"))
    lists = _listed(once).unionByName(copied.select("lang", "term", "n", "df", F.array(F.struct("source", "n")).alias("counts")))
    same = Window.partitionBy("lang", "term").orderBy("df")
    every = same.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    lists = lists.select(
        "lang",
        "term",
        "counts",
        F.sum("n").over(every).alias("lang_n"),
        F.sum("df").over(every).alias("lang_df"),
        (F.row_number().over(same) == 1).alias("head"),
    )
    counts = lists.filter(F.col("lang_df") >= least_docs).select("lang", "term", "lang_n", "head", F.posexplode("counts").alias("at", "c"))
    first = F.max((F.col("head") & (F.col("at") == 0)).cast("int")).alias("first")
    # Rows of a term are together already, so this moves none.
    counts = counts.groupBy("lang", F.col("c.source").alias("source"), "term", "lang_n").agg(F.sum("c.n").alias("n"), first)
    return materialise(counts.select("lang", "source", "term", "n", "lang_n", "first"), "divergence-counts"), groups


def share(n: str, total: str, kept: str) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * kept)), exactly."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + 2 AS DECIMAL(20, 0)) div CAST({total} + 2 * {kept} AS DECIMAL(20, 0))")


def gap(p: str, q: str) -> str:
    """floor((p - q)^2 / (p + q)); shares are below 2^31, so it fits a long."""
    return f"((({p}) - ({q})) * (({p}) - ({q})) div (({p}) + ({q})))"


def _sides(counts: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, total, nonzero, kept, lang_total, zero, block, blocks): one row per group."""
    langs = counts.groupBy("lang").agg(F.sum("first").alias("kept"), F.sum("n").alias("lang_total"))
    held = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("nonzero"))
    many = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    sides = groups.join(many, "lang").join(langs, "lang", "left").join(held, ["lang", "source"], "left")
    sides = sides.fillna(0, ["kept", "lang_total", "total", "nonzero"])
    zero = F.when(F.col("kept") > 0, share("0L", "total", "kept"))
    block = F.pmod(F.xxhash64("source"), F.col("blocks")).cast("int")
    return materialise(sides.withColumn("zero", zero).withColumn("block", block), "divergence-sides")


def _halves(rows: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows with block and blocks, dealt so that every two blocks meet once: left and right side."""
    left = rows.withColumn("lb", F.col("block")).withColumn("rb", F.explode(F.sequence(F.col("block"), F.col("blocks") - 1)))
    right = rows.withColumn("rb", F.col("block")).withColumn("lb", F.explode(F.sequence(F.lit(0), F.col("block"))))
    named = lambda df, end: df.select("lang", "lb", "rb", *[F.col(c).alias(c + end) if c != "term" else F.col(c) for c in keep])
    return named(left, "_a"), named(right, "_b")


def _pair(a: str = "source_a", b: str = "source_b") -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def pair_values(shares: DataFrame, sides: DataFrame) -> DataFrame:
    """(lang, a, b, value) for every two sources a < b of a language."""
    once = "lb < rb OR source_a < source_b"
    left, right = _halves(sides, ["source", "zero", "nonzero", "kept"])
    pairs = left.join(right, ["lang", "lb", "rb"]).filter(once)
    neither = f"CASE WHEN kept_a > 0 THEN (kept_a - nonzero_a - nonzero_b) * {gap('zero_a', 'zero_b')} ELSE 0L END"
    pairs = materialise(pairs.select("lang", "source_a", "zero_a", "source_b", "zero_b", F.expr(neither).alias("value")), "divergence-pairs")

    left, right = _halves(shares, ["term", "source", "p", "zero"])
    both = left.join(right, ["lang", "term", "lb", "rb"]).filter(once)
    more = f"{gap('p_a', 'p_b')} - {gap('p_a', 'zero_b')} - {gap('zero_a', 'p_b')} + {gap('zero_a', 'zero_b')}"
    both = both.select("lang", *_pair(), F.expr(more).alias("value"))

    counted = shares.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("m"))
    parts = counted.groupBy("lang", "source").agg(F.ceil(F.count(F.lit(1)) / HISTOGRAM_PART).cast("int").alias("parts"))
    counted = counted.join(parts, ["lang", "source"]).withColumn("part", F.pmod(F.xxhash64("p"), F.col("parts")).cast("int"))
    one = lambda s, t: pairs.select("lang", F.col(f"source_{s}").alias("source"), F.col(f"source_{t}").alias("other"), F.col(f"zero_{t}").alias("zero"))
    facing = one("a", "b").unionByName(one("b", "a")).join(parts, ["lang", "source"])
    facing = facing.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    alone = facing.join(counted.select("lang", "source", "part", "p", "m"), ["lang", "source", "part"])
    alone = alone.select("lang", *_pair("source", "other"), F.expr(f"m * {gap('p', 'zero')}").alias("value"))

    every = pairs.select("lang", *_pair(), "value").unionByName(both).unionByName(alone)
    return every.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank): distances to the other sources, and the source's own terms."""
    counts, groups = term_counts(docs, least_docs)
    sides = _sides(counts, groups)
    shares = attach(counts, sides.drop("nonzero"), ["lang", "source"])
    shares = shares.withColumn("p", share("n", "total", "kept")).withColumn("q", share("lang_n", "lang_total", "kept"))
    shares = materialise(shares.select("lang", "source", "term", "p", "q", "zero", "block", "blocks"), "divergence-shares")

    terms = shares.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr(gap("p", "q")).alias("value"))
    pairs = pair_values(shares, sides)
    ends = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item")))
    pairs = pairs.select("lang", F.explode(ends).alias("e"), "value").select("lang", "e.source", F.lit("pair").alias("part"), "e.item", "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(terms.withColumn("rank", rank).filter(F.col("rank") <= top))


OP13_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         unnest(CASE WHEN text IS NULL THEN [NULL] ELSE list_concat([NULL], regexp_extract_all(
           translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '{TERM}')) END) AS term FROM documents),
groups AS (SELECT DISTINCT lang, source FROM docs),
kept AS (SELECT lang, term FROM docs WHERE term IS NOT NULL GROUP BY ALL HAVING count(DISTINCT r) >= {LEAST_DOCS}),
v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v FROM kept GROUP BY lang),
found AS (SELECT lang, source, term, count(*) AS n FROM docs JOIN kept USING (lang, term) GROUP BY ALL),
dense AS (
  SELECT g.lang, g.source, k.term, CAST(coalesce(n, 0) AS HUGEINT) AS n,
         CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.lang, g.source) AS HUGEINT) AS total
  FROM groups g JOIN kept k ON g.lang = k.lang LEFT JOIN found f ON f.lang = g.lang AND f.source = g.source AND f.term = k.term),
langs AS (SELECT lang, term, CAST(sum(n) AS HUGEINT) AS n, CAST(sum(sum(n)) OVER (PARTITION BY lang) AS HUGEINT) AS total FROM dense GROUP BY lang, term),
p AS (SELECT lang, source, term, n, 1 + ({SCALE}::HUGEINT * (n + 2)) // (total + 2 * v) AS p FROM dense JOIN v USING (lang)),
q AS (SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + 2)) // (total + 2 * v) AS q FROM langs JOIN v USING (lang)),
far AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
items AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN far f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, CAST(((p - q) * (p - q)) // (p + q) AS BIGINT) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INTEGER) AS rank FROM items)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
