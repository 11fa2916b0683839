"""Conversation prefix trie over composable fingerprints.

Conversations are rebuilt symbolically: conversation c begins with the first turns of the
first conversation of its hundred (its head) and goes on with its own turns.  No rebuilt
text is ever made.  A sequence of turns has a fingerprint in a monoid of polynomial sums
modulo primes: with turn values e and a base B, S[k] = e1*B + ... + ek*B^k.  The product of a
head and of a piece of another conversation is their sums added, the piece's moved by a
power of B, so every rebuilt prefix costs one addition of stored prefix sums.

Rebuilt prefixes with equal depth and fingerprint are a node.  Each refers to the stored turn
it ends with, by the smallest row of an equal turn (equal role and text, compared in full).
All members of a node must refer to the same one; since a fingerprint less its last turn is
the parent's, equal references at every node make equal sequences by induction.  A node that
fails is a collision of fingerprints, and the trie is built anew with another base and, from a
parameter, other primes.

Sums over subtrees need no pairs of nodes.  A node is named by its smallest member.  The nodes
that one conversation names are the lower end of its path, so a subtree's sum is that of its
members' totals, less what the smallest member names above the node.

Positions and prefix sums are made in two levels (ranges of the order, blocks of positions),
aggregates are combined map-side, and lookups come back by a measured broadcast or a salted
join: neither a conversation nor a first turn with a third of all rows is one task.  The
conversations that end in one node are written in ranges and hashed as a stream.

Defined cases: null role or text is empty; null turns come first; rows of one turn are
ordered by role, then text; repeated rows are turns of their own; rows without conv_id belong
to no conversation; no conversations give no node, not even the root; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from burnish.llm.common import small_batches
from burnish.operators.skew import attach
from burnish.session import materialise

HUNDRED = 100
HEADS = 6  # the head has crc32(conv_id) modulo this many turns
MODULI = ((2147483647, 2147483629, 2147483587),)  # primes below 2^31, so that products fit a long
ATTEMPTS = 8
BITS = 32  # of a position
BLOCK_BITS = 12
LEAD = 64  # characters of a text that decide its range


class Collision(Exception):
    """Different turns or prefixes met in one fingerprint."""


def _bases(moduli, attempt: int) -> list[int]:
    spread = [int.from_bytes(hashlib.sha256(f"trie:{attempt}:{p}:{i}".encode()).digest()[:8], "big") for i, p in enumerate(moduli)]
    return [2 + s % (p - 3) for s, p in zip(spread, moduli)]


def _power(exponent: Column, base: int, modulus: int) -> Column:
    """base ** exponent by the exponent's bits."""
    out = F.lit(1).cast("long")
    for bit in range(BITS):
        square = F.lit(pow(base, 1 << bit, modulus)).cast("long")
        out = out * F.when(F.getbit(exponent, F.lit(bit)) == 1, square).otherwise(F.lit(1).cast("long")) % F.lit(modulus)
    return out


def earlier_sums(rows: DataFrame, key: str, at: str, values: list[str]) -> DataFrame:
    """Adds ``before_<value>``: the sum over rows of the key with a smaller ``at``, in two levels."""
    rows = rows.withColumn("_block", F.shiftright(at, BLOCK_BITS))
    inside = Window.partitionBy(key, "_block").orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy(key, "_block").agg(*[F.sum(v).alias(f"_of_{v}") for v in values])
    over = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    none = lambda c: F.coalesce(c, F.lit(0))
    blocks = blocks.select(key, "_block", *[none(F.sum(f"_of_{v}").over(over)).alias(f"_to_{v}") for v in values])
    placed = rows.select("*", *[none(F.sum(v).over(inside)).alias(f"_in_{v}") for v in values]).join(blocks, [key, "_block"])
    sums = [(F.col(f"_in_{v}") + F.col(f"_to_{v}")).cast("long").alias(f"before_{v}") for v in values]
    return placed.select(*[c for c in rows.columns if c != "_block"], *sums)


def stored_turns(conversations: DataFrame) -> DataFrame:
    """(row, conv_id, pos, role, text), positions from 1 counted over ranges of the order."""
    empty = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), empty("role").alias("role"), empty("text").alias("text")
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role")]
    dealt = turns.repartitionByRange("conv_id", *order, F.substring("text", 1, LEAD))
    dealt = materialise(dealt.select("*", F.spark_partition_id().alias("_range"), F.monotonically_increasing_id().alias("row")), "trie-ranges")
    counts = dealt.groupBy("conv_id", "_range").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy("conv_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("conv_id", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    rank = F.row_number().over(Window.partitionBy("conv_id", "_range").orderBy(*order, "text"))
    placed = dealt.withColumn("_rank", rank).join(offsets, ["conv_id", "_range"])
    return placed.select("row", "conv_id", (F.col("_offset") + F.col("_rank")).cast("long").alias("pos"), "role", "text")


def referred_turns(turns: DataFrame, attempt: int = 0) -> DataFrame:
    """(conv_id, pos, chars, a, b, ref): ``ref`` is the smallest row with equal role and text."""
    keys = [F.xxhash64(F.lit(attempt), "role", "text").alias("a"), F.xxhash64("text", "role", F.lit(attempt)).alias("b")]
    narrow = materialise(turns.select("*", *keys).select("row", "conv_id", "pos", F.length("text").alias("chars"), "a", "b", "role", "text"), "trie-turns")
    said = narrow.groupBy("a", "b", "role", "text").agg(F.min("row").alias("row"))
    said = materialise(said.groupBy("a", "b").agg(F.min("row").alias("ref"), F.count(F.lit(1)).alias("texts")), "trie-references")
    if not said.filter("texts > 1").isEmpty():
        raise Collision("different turns with one hash")
    return attach(narrow.drop("row", "role", "text"), said.drop("texts"), ["a", "b"])


def rebuilt(turns: DataFrame, moduli, attempt: int = 0, hundred: int = HUNDRED, heads: int = HEADS) -> DataFrame:
    """(c, d, f0.., g0.., ref, chars, last): every rebuilt prefix, its and its parent's fingerprint."""
    bases, each = _bases(moduli, attempt), range(len(moduli))
    value = lambda i, p: F.pmod(F.xxhash64("a", "b", F.lit(attempt), F.lit(i)), F.lit(p - 1)) + 1
    terms = turns.select(
        "conv_id", "pos", "chars", "ref", *[(value(i, p) * _power(F.col("pos"), bases[i], p) % F.lit(p)).alias(f"t{i}") for i, p in enumerate(moduli)]
    )
    sums = earlier_sums(terms, "conv_id", "pos", [f"t{i}" for i in each])
    whole = [F.pmod(F.col(f"before_t{i}") + F.col(f"t{i}"), F.lit(p)).alias(f"s{i}") for i, p in enumerate(moduli)]
    parts = [F.pmod(F.col(f"before_t{i}"), F.lit(p)).alias(f"r{i}") for i, p in enumerate(moduli)]
    sums = materialise(sums.select("conv_id", "pos", "chars", "ref", *whole, *parts), "trie-sums")

    first = [F.max(F.when(F.col("pos") == k, F.col(f"s{i}"))).alias(f"h{i}_{k}") for i in each for k in range(1, heads)]
    known = sums.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), *first)
    known = materialise(known, "trie-conversations")
    at = lambda side, i, k: F.coalesce(F.element_at(F.array(F.lit(0).cast("long"), *[F.col(f"{side}.h{i}_{j}") for j in range(1, heads)]), k + 1), F.lit(0))
    own, base = known.alias("own"), known.alias("base")
    head = (F.crc32(F.col("own.conv_id").cast("string").cast("binary")) % heads).cast("int")
    both = own.join(base, F.col("base.conv_id") == F.col("own.conv_id") - F.col("own.conv_id") % hundred, "left")
    both = both.withColumn("h", head).withColumn("kept", F.least(F.col("h"), F.coalesce(F.col("base.n"), F.lit(0))).cast("int"))
    plan = both.select(
        F.col("own.conv_id").alias("c"),
        (F.col("own.conv_id") - F.col("own.conv_id") % hundred).alias("base"),
        "h",
        "kept",
        (F.col("kept") + F.greatest(F.col("own.n") - F.col("h"), F.lit(0))).alias("turns"),
        *[at("base", i, F.col("kept")).alias(f"head{i}") for i in each],
        *[at("own", i, F.col("h")).alias(f"skip{i}") for i in each],
    )
    plan = materialise(plan, "trie-plan")

    prints = [f"{side}{i}" for side in "fg" for i in each]
    root = plan.select("c", F.lit(0).cast("long").alias("d"), *[F.lit(0).cast("long").alias(x) for x in prints], F.lit(-1).cast("long").alias("ref"), F.lit(0).alias("chars"), (F.col("turns") == 0).alias("last"))
    led = sums.filter(F.col("pos") < heads).withColumnRenamed("conv_id", "base").join(plan.filter("kept > 0"), "base").filter(F.col("pos") <= F.col("kept"))
    led = led.select("c", F.col("pos").alias("d"), *[F.col(f"{s}{i}").alias(f"{t}{i}") for s, t in ("sf", "rg") for i in each], "ref", "chars", (F.col("pos") == F.col("turns")).alias("last"))

    consts = plan.select(F.col("c").alias("conv_id"), "h", (F.col("h") - F.col("kept")).alias("back"), "turns", *[f"{x}{i}" for x in ("head", "skip") for i in each])
    said = attach(sums, consts, ["conv_id"]).filter(F.col("pos") > F.col("h")).withColumn("d", F.col("pos") - F.col("back"))

    def joined(side: str, i: int) -> Column:
        p = F.lit(moduli[i])
        inverse = pow(bases[i], -1, moduli[i])
        back = F.element_at(F.array(*[F.lit(pow(inverse, k, moduli[i])).cast("long") for k in range(heads)]), F.col("back") + 1)
        return F.pmod(F.col(f"head{i}") + F.pmod(F.col(f"{side}{i}") - F.col(f"skip{i}"), p) * back, p)

    said = said.select(F.col("conv_id").alias("c"), "d", *[joined(s, i).alias(f"{t}{i}") for s, t in ("sf", "rg") for i in each], "ref", "chars", (F.col("d") == F.col("turns")).alias("last"))
    return materialise(root.unionByName(led).unionByName(said), "trie-prefixes")


def _hashed(node: list[str]):
    """Streams the id lists of sorted nodes into SHA-256."""
    digest = "sha256"

    def run(batches):
        import hashlib as hashing

        import pandas as pd

        key, state = None, None
        for batch in batches:
            done = []
            for *now, ids in batch[[*node, "ids"]].itertuples(index=False):
                if now != key:
                    if key is not None:
                        done.append((*key, state.hexdigest()))
                    key, state = now, hashing.new(digest)
                else:
                    state.update(b",")
                state.update(ids.encode())
            yield pd.DataFrame(done, columns=[*node, "ends_sha256"])
        if key is not None:
            yield pd.DataFrame([(*key, state.hexdigest())], columns=[*node, "ends_sha256"])

    return run


def ends_digest(ends: DataFrame, node: list[str]) -> DataFrame:
    """(node.., c) -> (node.., ends_sha256) of the ids in order, comma-joined.

    Ids are listed per range of (node, id) first, so a node with very many is spread; then the
    lists of a node, few and in order, are hashed one after another without being joined.
    """
    dealt = materialise(ends.repartitionByRange(*node, "c").withColumn("_range", F.spark_partition_id()), "trie-ends")
    listed = dealt.groupBy(*node, "_range").agg(F.array_join(F.transform(F.array_sort(F.collect_list("c")), lambda c: c.cast("string")), ",").alias("ids"))
    ordered = small_batches(listed.repartition(*node).sortWithinPartitions(*node, "_range"))
    kinds = ", ".join(f"{n} bigint" for n in node)
    return ordered.mapInPandas(_hashed(node), f"{kinds}, ends_sha256 string")


def _trie(turns: DataFrame, moduli, attempt: int, hundred: int, heads: int) -> DataFrame:
    prefixes = rebuilt(referred_turns(turns, attempt), moduli, attempt, hundred, heads)
    each = range(len(moduli))
    node, above = ["d", *[f"f{i}" for i in each]], ["d", *[f"g{i}" for i in each]]
    nodes = prefixes.groupBy(*node).agg(
        F.min("c").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"),
        F.min("ref").alias("ref"),
        F.max("ref").alias("other"),
        F.max("chars").alias("chars"),
        *[F.max(f"g{i}").alias(f"g{i}") for i in each],
    )
    nodes = materialise(nodes, "trie-nodes")
    if not nodes.filter("ref <> other").isEmpty():
        raise Collision("different prefixes with one fingerprint")

    children = nodes.filter("d > 0").groupBy((F.col("d") - 1).alias("d"), *[F.col(f"g{i}").alias(f"f{i}") for i in each]).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select((F.col("d") + 1).alias("d"), *[F.col(f"f{i}").alias(f"g{i}") for i in each], F.col("conv_id").alias("parent_conv_id"))
    nodes = nodes.join(children, node, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumn("weight", (F.col("n_convs") - 1) * F.col("chars")).withColumn("leaf", (F.col("n_children") == 0).cast("long"))
    nodes = materialise(earlier_sums(nodes, "conv_id", "d", ["weight"]), "trie-weights")

    named = nodes.groupBy(F.col("conv_id").alias("c")).agg(F.sum("weight").alias("named"), F.sum("leaf").alias("leaves"))
    below = attach(prefixes.select("c", *node), named, ["c"]).groupBy(*node).agg(F.sum("named").alias("below"), F.sum("leaves").alias("n_leaves"))
    ends = ends_digest(prefixes.filter("last").select(*node, "c"), node)
    done = attach(nodes, parents, above).join(below, node).join(ends, node, "left")
    return done.select(
        "conv_id",
        F.col("d").alias("depth"),
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        (F.col("below") - F.col("before_weight")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


def prefix_trie(conversations: DataFrame, moduli=MODULI, hundred: int = HUNDRED, heads: int = HEADS, attempts: int = ATTEMPTS) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    ``moduli`` lists tuples of primes, taken in turn after a collision, the last one for all
    further attempts.
    """
    turns = stored_turns(conversations)
    for attempt in range(attempts):
        try:
            return _trie(turns, moduli[min(attempt, len(moduli) - 1)], attempt, hundred, heads)
        except Collision as found:
            last = found
    raise RuntimeError(f"no collision-free fingerprints after {attempts} attempts: {last}")


OP12_SQL = r"""
WITH RECURSIVE rounds(i, v, k) AS (
  SELECT CAST(range AS BIGINT), CAST(range AS BIGINT), 0 FROM range(256)
  UNION ALL SELECT i, xor(v >> 1, 3988292384 * (v & 1)), k + 1 FROM rounds WHERE k < 8),
crc AS (SELECT list(v ORDER BY i) AS t FROM rounds WHERE k = 8),
turns AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
         lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 6 AS h
  FROM (SELECT DISTINCT c FROM turns), crc),
pieces AS (
  SELECT v.c, 0 AS part, pos, role, text FROM convs v JOIN turns t ON t.c = v.base AND t.pos <= v.h
  UNION ALL SELECT v.c, 1, pos, role, text FROM convs v JOIN turns t ON t.c = v.c AND t.pos > v.h),
numbered AS (SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS d, role, text FROM pieces),
prefixes AS (
  SELECT c, d, list({'r': role, 't': text}) OVER (PARTITION BY c ORDER BY d) AS key, length(text) AS chars FROM numbered
  UNION ALL SELECT c, 0, [], 0 FROM convs),
lasts AS (SELECT c, max(d) AS turns FROM prefixes GROUP BY c),
nodes AS (
  SELECT key, p.d, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
         sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (turns = p.d), '')) AS ends_sha256
  FROM prefixes p JOIN lasts USING (c) GROUP BY key, p.d),
linked AS (
  SELECT n.*, q.key AS above, q.conv_id AS parent_conv_id
  FROM nodes n LEFT JOIN prefixes r ON r.c = n.conv_id AND r.d = n.d - 1 LEFT JOIN nodes q ON q.key = r.key),
children AS (SELECT above AS key, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY above),
under AS (
  SELECT r.key, count(*) FILTER (coalesce(n_children, 0) = 0) AS n_leaves, sum((n_convs - 1) * n.chars) AS saved
  FROM nodes n LEFT JOIN children k ON k.key = n.key JOIN prefixes r ON r.c = n.conv_id AND r.d <= n.d GROUP BY r.key)
SELECT conv_id, CAST(d AS BIGINT) AS depth, parent_conv_id, n_convs, coalesce(n_children, 0) AS n_children, n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM linked l JOIN under u ON u.key = l.key LEFT JOIN children k ON k.key = l.key
"""
