"""Mixing sources to target weights with DataFrame functions only.

Every document gets a hash-random key.  Within its source the documents are ordered by
that key; a prefix sum of their sizes tells where the source's budget ends.  Budgets above
a source's size repeat it in whole epochs, and the last epoch is cut at the exact word.

The prefix sum is distributed: the key's leading bits are a bucket, and a source has so many
buckets that each holds at most about ``BUCKET_ROWS`` of its rows, a hot source as well as a
small one.  Sums per bucket are added up first, in blocks of ``2**BLOCK_BITS`` buckets and
then over blocks, and the rows within each bucket last.  No task ever orders a whole source,
nor the buckets of one.

Defined cases: a null text has size 0; a null source is a source of its own, sorted last;
a document of size 0 takes 0; rows with equal keys (the same doc_id) are ordered by size,
and exact copies are interchangeable; an empty table gives an empty result; input columns
named like an output column are replaced.
"""

from __future__ import annotations

from math import lcm

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnish.llm.common import words_regex
from burnish.session import materialise

WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # of all sizes, as a fraction
CAP = 2
SEED = "mix-1"
BUCKET_ROWS = 256
BUCKET_BITS = 24  # leading bits of the key that may be a bucket
BLOCK_BITS = 12
ADDED = ("size", "source_size", "target", "taken")


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(words_regex())), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights=WEIGHTS, share=SHARE, cap: int = CAP) -> DataFrame:
    """Rows with _source and source_size -> the same with ``target``: one narrow row per source.

    Sharing by weight and resharing the excess of capped sources ends at one level: with the
    sources in order of size per weight, the capped ones are a prefix of that order.
    """
    num, den = share
    common = lcm(*weights)
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    ranked = sizes.withColumn("_i", F.row_number().over(by_name))
    ranked = ranked.withColumn("_w", F.element_at(F.array(*map(F.lit, weights)), F.col("_i") % len(weights) + F.when(F.col("_i") % len(weights) == 0, len(weights)).otherwise(0)).cast("long"))
    level = [(F.col("source_size") * F.lit(common) / F.col("_w")).cast("decimal(38,0)"), F.col("_i")]
    before = Window.orderBy(*level).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    exact = lambda c: c.cast("decimal(38,0)")
    ranked = ranked.select(
        "*",
        F.row_number().over(Window.orderBy(*level)).alias("_k"),
        F.coalesce(F.sum("source_size").over(before), F.lit(0)).alias("_cs"),
        F.coalesce(F.sum("_w").over(before), F.lit(0)).alias("_cw"),
        F.sum("source_size").over(everything).alias("_all"),
        F.sum("_w").over(everything).alias("_allw"),
    )
    left = F.lit(num) * F.col("_all") - F.lit(den * cap) * F.col("_cs")
    fits = exact(left) * F.col("_w") <= exact(F.lit(den * cap) * F.col("source_size")) * (F.col("_allw") - F.col("_cw"))
    ranked = ranked.withColumn("_left", left).withColumn("_first", F.min(F.when(fits, F.col("_k"))).over(everything))
    at_first = lambda c: F.max(F.when(F.col("_k") == F.col("_first"), c)).over(everything)
    level_value = (F.col("_w") * at_first(F.col("_left"))).cast("double") / (F.lit(den) * at_first(F.col("_allw") - F.col("_cw"))).cast("double")
    target = F.when(F.col("_k") < F.col("_first"), (F.col("source_size") * cap).cast("double")).otherwise(level_value)
    return ranked.select(*sizes.columns, target.alias("target"))


def bucket_offsets(sums: DataFrame) -> DataFrame:
    """(_name, _bucket, _sum) -> (_name, _bucket, _offset): the sum of the earlier buckets of a source."""
    before = Window.rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c, keys, at: F.coalesce(F.sum(c).over(before.partitionBy(*keys).orderBy(at)), F.lit(0))
    placed = sums.withColumn("_block", F.shiftright("_bucket", BLOCK_BITS))
    inside = placed.withColumn("_inside", earlier("_sum", ("_name", "_block"), "_bucket"))
    blocks = placed.groupBy("_name", "_block").agg(F.sum("_sum").alias("_all"))
    blocks = blocks.select("_name", "_block", earlier("_all", ("_name",), "_block").alias("_before"))
    return inside.join(blocks, ["_name", "_block"]).select("_name", "_bucket", (F.col("_before") + F.col("_inside")).alias("_offset"))


def mix(docs: DataFrame, weights=WEIGHTS, share=SHARE, cap: int = CAP, seed: str = SEED, bucket_rows: int = BUCKET_ROWS, without: tuple = ()) -> DataFrame:
    """All rows of ``docs`` (columns in ``without`` left out) with ``size``, ``source_size``, ``target`` and ``taken``."""
    kept = [c for c in docs.columns if c not in ADDED]
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":" + seed)).cast("binary"))
    source = F.col("source").cast("string")
    name = F.coalesce(F.concat(F.lit("="), source), F.lit(""))  # never null, so that joins on it reuse its partitioning
    base = materialise(
        docs.select(F.struct(*[c for c in kept if c not in without]).alias("_row"), name.alias("_name"), source.alias("_source"), size_of().alias("size"), key.alias("_key")),
        "mix",
    )
    sources = base.groupBy("_name", "_source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("_n"))
    bits = F.least(F.lit(BUCKET_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") / bucket_rows)))).cast("int")
    sources = materialise(source_targets(sources.withColumn("_bits", bits), weights, share, cap).drop("_source", "_n"), "mix-sources")
    lead = F.conv(F.substring("_key", 1, BUCKET_BITS // 4), 16, 10).cast("long")
    base = base.drop("_source").withColumn("_lead", lead).join(sources, "_name")
    base = base.withColumn("_bucket", F.expr(f"shiftright(_lead, {BUCKET_BITS} - _bits)"))
    sums = materialise(base.groupBy("_name", "_bucket").agg(F.sum("size").alias("_sum")), "mix-sums")
    offsets = materialise(bucket_offsets(sums), "mix-offsets")

    within = Window.partitionBy("_name", "_bucket").orderBy("_key", F.col("_row.doc_id"), "size").rowsBetween(Window.unboundedPreceding, 0)
    run = base.withColumn("_run", F.sum("size").over(within)).join(offsets, ["_name", "_bucket"])
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("CAST(floor(target) AS BIGINT) div source_size")).otherwise(F.lit(0))
    start = F.col("_offset") + F.col("_run") - F.col("size")
    rest = budget - epochs * F.col("source_size") - start
    taken = (epochs * F.col("size") + F.greatest(F.lit(0), F.least(F.col("size"), rest))).cast("long")
    return run.select(*[F.col("_row")[c].alias(c) for c in kept if c not in without], "size", "source_size", "target", taken.alias("taken"))


OP8_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':mix-1') AS key
  FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
named AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS i FROM sources),
weighted AS (SELECT *, CAST(CASE i % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS BIGINT) AS w FROM named),
levels AS (
  SELECT *, row_number() OVER o AS k,
         coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cs,
         coalesce(sum(w) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS cw,
         sum(source_size) OVER () AS alls, sum(w) OVER () AS allw
  FROM weighted WINDOW o AS (ORDER BY source_size * (10 // w), i)),
first AS (SELECT min(k) AS f FROM levels WHERE (3 * alls - 4 * cs) * w <= 4 * source_size * (allw - cw)),
level AS (SELECT 3 * alls - 4 * cs AS rest, 2 * (allw - cw) AS wide FROM levels, first WHERE k = f),
targets AS (
  SELECT source, source_size,
         CASE WHEN k < f THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(w * rest AS DOUBLE) / CAST(wide AS DOUBLE) END AS target
  FROM levels, first, level),
running AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target) AS BIGINT) AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS UNBOUNDED PRECEDING) - s.size AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
         + greatest(0, least(size, budget - (budget // source_size) * source_size - start)) END AS BIGINT) AS taken
FROM running
"""
