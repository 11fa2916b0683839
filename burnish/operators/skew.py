"""Joining a large, possibly skewed frame to one row per key.

A group total, a flagged key or a master record has to come back to the rows it
belongs to.  The lookup has one row per key; the data may hold a third of its rows
under a single key.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.session import materialise

# A lookup is broadcast only after it was measured and found below both limits.
BROADCAST_ROWS = 200_000
BROADCAST_TEXT_BYTES = 32 << 20
# A key is hot when it holds more than this share of the rows.  By arithmetic there
# are fewer than 1 / HOT_SHARE such keys, so the hot list always fits a broadcast.
HOT_SHARE = 0.001
SALTS = 64
# Bits that tell which rows a lookup may concern are broadcast, in blocks of 512 words of 64 bits:
# eight bits a key, and never more than 32 MB.
BLOCK_WORDS = 512
KEY_BITS = 8
MAX_BLOCKS = 8_192


def is_small(df: DataFrame, max_rows: int | None = None) -> bool:
    """True when ``df`` is within the broadcast limits, by counted rows and bytes of varying size."""
    limit = BROADCAST_ROWS if max_rows is None else max_rows
    nested = (T.StructType, T.ArrayType, T.MapType)
    text = [
        F.sum(F.octet_length(name.cast("string") if isinstance(f.dataType, nested) else name))
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BinaryType, *nested))
        for name in [F.col(f"`{f.name}`")]
    ]
    row = df.agg(F.count(F.lit(1)), *text).first()
    return row[0] <= limit and sum(x or 0 for x in row[1:]) <= BROADCAST_TEXT_BYTES


def hot_keys(df: DataFrame, on: list[str], share: float = HOT_SHARE) -> list[tuple]:
    """Keys (NULL included) holding more than ``share`` of all rows: under 1 / share of them."""
    counts = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return [tuple(row) for row in counts.filter(F.col("_n") > total * F.lit(share)).select(*on).collect()]


def attach(
    df: DataFrame,
    lookup: DataFrame,
    on: list[str],
    max_broadcast_rows: int | None = None,
    salts: int = SALTS,
    few: bool = False,
) -> DataFrame:
    """Left join ``df`` to ``lookup`` (unique on ``on``), keeping every row of ``df``.

    The lookup is an aggregate, so it is computed once, stored, and measured.  A small
    one is broadcast and ``df`` is not shuffled.  A larger one is joined by shuffle; if
    some keys are hot their rows are spread over ``salts`` partitions and only the hot
    lookup rows are repeated.  The salt is a hash of the row's other columns, moved by the
    input partition number for exact copies, so a task run again after an executor loss
    salts the same way and input clustered by the key is spread all the same.

    ``few`` says that most rows have no match.  Bits of the lookup's hashed keys are then broadcast,
    rows whose bit is not set stay where they are, and only the others are joined by shuffle.
    ``df`` is read twice for that.
    """
    added = [c for c in lookup.columns if c not in on]
    lookup = materialise(lookup, "lookup")
    if is_small(lookup, max_broadcast_rows):
        return df.join(F.broadcast(lookup), on, "left").select(*df.columns, *added)
    if few and hashable(df, on):
        near, far = _split(df, lookup, on)
        unmatched = [F.lit(None).cast(lookup.schema[c].dataType).alias(c) for c in added]
        return _shuffled(near, lookup, on, added, salts).unionByName(far.select(*df.columns, *unmatched))
    return _shuffled(df, lookup, on, added, salts)


# Types of which equal values hash alike (strings: only if they are compared byte by byte).
_HASHED = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)


def hashable(df: DataFrame, on: list[str]) -> bool:
    """True when rows with equal ``on`` are sure to have equal hashes."""
    kinds = [df.schema[c].dataType for c in on]
    return all(isinstance(k, _HASHED) or (isinstance(k, T.StringType) and k.isUTF8BinaryCollation()) for k in kinds)


def _split(df: DataFrame, lookup: DataFrame, on: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows that may have a match in ``lookup``, and rows that have none.

    With eight bits a key a ninth of the rows without a match is taken along; where ``lookup`` outgrows
    the largest bitmap it is more, up to all rows.
    """
    blocks = min(MAX_BLOCKS, -(-max(lookup.count(), 1) * KEY_BITS // (BLOCK_WORDS * 64)))
    hashed = F.xxhash64(*[F.col(f"`{c}`").cast(df.schema[c].dataType) for c in on])
    block = F.pmod(hashed, F.lit(blocks))
    place = F.pmod(F.shiftright(hashed, 32), F.lit(BLOCK_WORDS)).cast("int")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(F.shiftright(hashed, 48), F.lit(64)).cast("int"))
    lit = lookup.select((block * BLOCK_WORDS + place).alias("_word"), bit.alias("_bit"))
    dark = df.sparkSession.range(blocks * BLOCK_WORDS).select(F.col("id").alias("_word"), F.lit(0).cast("bigint").alias("_bit"))
    words = lit.unionByName(dark).groupBy("_word").agg(F.bit_or("_bit").alias("_bits"))
    # Every word of a block is there, so its place in the sorted list is its number.
    listed = words.groupBy(F.floor(F.col("_word") / BLOCK_WORDS).alias("_block")).agg(
        F.array_sort(F.collect_list(F.struct("_word", "_bits"))).alias("_words")
    )
    bitmap = materialise(listed.select("_block", F.col("_words._bits").alias("_words")), "bits")
    asked = df.withColumn("_block", block).join(F.broadcast(bitmap), "_block", "left")
    found = F.coalesce(F.get("_words", place).bitwiseAND(bit) != 0, F.lit(False))
    return asked.filter(found).select(*df.columns), asked.filter(~found).select(*df.columns)


def _shuffled(df: DataFrame, lookup: DataFrame, on: list[str], added: list[str], salts: int) -> DataFrame:
    hot = hot_keys(df, on)
    if not hot:
        return df.join(lookup, on, "left").select(*df.columns, *added)

    marked = [f"_hot_{i}" for i in range(len(on))]
    schema = T.StructType([T.StructField(h, df.schema[c].dataType) for c, h in zip(on, marked)])
    hot_frame = df.sparkSession.createDataFrame(hot, schema).withColumn("_hot", F.lit(True))

    def mark(frame: DataFrame) -> DataFrame:
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(h)) for c, h in zip(on, marked)])
        return frame.join(F.broadcast(hot_frame), same, "left").drop(*marked)

    plain = [F.col(f"`{f.name}`") for f in df.schema.fields if f.name not in on and not isinstance(f.dataType, T.MapType)]
    own = F.xxhash64(*plain) if plain else F.lit(0).cast("bigint")
    spread = F.when(F.col("_hot"), F.pmod(own + F.spark_partition_id(), F.lit(salts)).cast("int")).otherwise(F.lit(0))
    copies = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted = mark(df).withColumn("_salt", spread).drop("_hot")
    repeated = mark(lookup).withColumn("_salt", F.explode(copies)).drop("_hot")
    return salted.join(repeated, [*on, "_salt"], "left").select(*df.columns, *added)
