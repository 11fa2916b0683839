"""SimHash near-duplicates joined on a grid of per-segment bit counts.

A 64-bit fingerprint is cut into 16 segments of 4 bits and embedded as the 16 bit counts.
One flipped bit moves one count by one, so the Manhattan distance of two embeddings is a
lower bound of their Hamming distance.  Fingerprints at two or fewer differing bits have a
midpoint one flip away from either, hence a grid cell at Manhattan distance at most one
from both.  Every fingerprint is entered in its own cell and the 32 beside it; a cell that
only one fingerprint entered can hold no link.  In the cells left, links are verified
exactly: the members name their midpoints in that cell, and two members that name the same
one differ in at most two bits.  At most 65 fingerprints can name a midpoint, so no group
grows with the data and no list of pairs is made, however large a group of near copies is.

Documents with equal fingerprints are linked by it and enter the grid once.

Defined cases: a null or blank text has no words and fingerprint zero, linked like any
other; a null doc_id never names a component unless the whole component has none; repeated
rows are one group; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.llm.common import small_batches
from burnish.llm.components import components
from burnish.session import materialise

SHINGLE = 3
SEED = 42
SEGMENTS = 16
WIDTH = 4
CHUNK = 1 << 14  # shingles whose bits are unpacked at once


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Signed 64-bit fingerprint of a whole text: a bit is set if it is in over half the hashes."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        hashes = [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
    else:
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[: -shingle] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends[shingle - 1 :].tolist())]
    h = np.array(hashes, dtype=">u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), CHUNK):
        part = h[at : at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h)).view(">i8")[0])


@F.pandas_udf(T.LongType())
def _simhash(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([simhash(t) for t in texts], dtype="int64")


def fingerprint(text: str = "text") -> Column:
    return _simhash(F.col(text).cast("string"))


def _counts(fp: str) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(F.col(fp), WIDTH * i).bitwiseAND(F.lit(2**WIDTH - 1))).cast("long") for i in range(SEGMENTS)]


def links(fingerprints: DataFrame) -> DataFrame:
    """Distinct fingerprints (``fp``) -> (a, b): enough verified links to connect all within two bits."""
    side = WIDTH + 1
    counts = fingerprints.select("fp", *[c.alias(f"c{i}") for i, c in enumerate(_counts("fp"))])
    cell = sum((F.col(f"c{i}") * F.lit(side**i) for i in range(1, SEGMENTS)), F.col("c0"))
    placed = counts.withColumn("cell", cell)
    near = [F.col("cell")]
    for i in range(SEGMENTS):
        near.append(F.when(F.col(f"c{i}") < WIDTH, F.col("cell") + F.lit(side**i)))
        near.append(F.when(F.col(f"c{i}") > 0, F.col("cell") - F.lit(side**i)))
    entered = placed.select("fp", F.explode(F.array(*near)).alias("cell")).filter(F.col("cell").isNotNull())
    shared = entered.groupBy("cell").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi")).filter(F.col("lo") != F.col("hi")).select("cell")
    shared = materialise(shared, "simhash-cells")

    flips = F.explode(F.sequence(F.lit(-1), F.lit(63))).alias("bit")
    named = placed.select("fp", "cell", flips)
    mask = F.when(F.col("bit") < 0, F.lit(0).cast("long")).otherwise(F.expr("shiftleft(1L, bit)"))
    step = F.element_at(F.array(*[F.lit(side**i).cast("long") for i in range(SEGMENTS)]), (F.expr("bit div 4") + 1).cast("int"))
    is_set = F.col("fp").bitwiseAND(mask) != 0
    moved = F.when(F.col("bit") < 0, F.col("cell")).when(is_set, F.col("cell") - step).otherwise(F.col("cell") + step)
    named = named.select("fp", F.col("fp").bitwiseXOR(mask).alias("mid"), moved.alias("cell"))
    named = named.join(shared, "cell", "left_semi")
    least = F.min("fp").over(Window.partitionBy("mid"))
    return named.select(F.col("fp").alias("a"), least.alias("b")).filter(F.col("a") != F.col("b"))


def classes(prints: DataFrame) -> DataFrame:
    """(doc_id, fp) -> (fp, component_id), one row per distinct fingerprint."""
    distinct = materialise(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    roots = components(links(distinct.select("fp")))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = rooted.withColumn("root", F.coalesce("root", "fp"))
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(smallest, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    prints = materialise(small_batches(docs).select("doc_id", fingerprint().alias("fp")), "simhash")
    done = prints.join(materialise(classes(prints), "simhash-classes"), "fp")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return done.select("doc_id", digits.alias("fingerprint"), "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, the one with the smallest doc_id; all columns kept.

    Of rows with that doc_id the one with the smallest text hash stays; exact repeats of it
    are one row.  Texts are shuffled once, on (doc_id, hash), which no group skews.
    """
    names = docs.columns
    packed = small_batches(docs).select(F.struct(*names).alias("_row"), "doc_id", F.xxhash64("text").alias("_h"), F.col("text").alias("_text"))
    prints = materialise(packed.select("doc_id", "_h", fingerprint("_text").alias("fp")), "simhash")
    one = prints.join(materialise(classes(prints), "simhash-classes"), "fp").groupBy("component_id")
    one = one.agg(F.min(F.when(F.col("doc_id").eqNullSafe(F.col("component_id")), F.struct("doc_id", "_h"))).alias("k"), F.min("_h").alias("_any"))
    one = materialise(one.select("k.*").distinct(), "simhash-kept").select(F.col("doc_id").alias("_id"), F.col("_h").alias("_kh"))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_kh"))
    kept = packed.drop("_text").join(one, same, "left_semi")
    repeated = prints.groupBy("doc_id", "_h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).count()
    if repeated:
        first = F.row_number().over(Window.partitionBy("doc_id", "_h").orderBy(F.xxhash64("_row")))
        kept = kept.withColumn("_first", first).filter("_first = 1")
    return kept.select("_row.*")
