import hashlib
import math
import zlib

import pytest
from helpers import as_table, rows, sql_rows
from pyspark.sql import functions as F

from burnish.llm import trie

TURNS = "conv_id long, turn long, role string, text string"
OUT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(data):
    """The contract on lists of turns; % keeps the sign, as in SQL."""
    turns = {}
    for c, turn, role, text in data:
        if c is not None:
            turns.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    told = {c: [t[2:] for t in sorted(ts)] for c, ts in turns.items()}
    head = {c: (zlib.crc32(str(c).encode()) & 0xFFFFFFFF) % 6 for c in told}
    built = {c: tuple(told.get(c - int(math.fmod(c, 100)), [])[: head[c]] + told[c][head[c] :]) for c in told}
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(ts[:d], []).append(c)
    saved, leaves, children = dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0), dict.fromkeys(nodes, 0)
    for key in nodes:
        if key:
            children[key[:-1]] += 1
    for key, members in nodes.items():
        for d in range(len(key) + 1):
            saved[key[:d]] += (len(members) - 1) * (len(key[-1][1]) if key else 0)
            leaves[key[:d]] += not children[key]
    out = []
    for key, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(members) if len(built[c]) == len(key))
        out.append((min(members), len(key), min(nodes[key[:-1]]) if key else None, len(members), children[key], leaves[key], saved[key], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def found(df, **how):
    return sorted((tuple(r[c] for c in OUT) for r in trie.prefix_trie(df, **how).collect()), key=str)


def check(spark, data, **how):
    df = spark.createDataFrame(data, TURNS)
    assert found(df, **how) == plain(data)
    return df


def talk(n=260, kinds=5):
    """Shared heads, equal conversations, gaps in the ids and bases that are absent."""
    data = []
    for c in range(0, n * 3, 3):
        for t in range(c % 9):
            data.append((c, t, "user" if t % 2 == 0 else "assistant", f"turn {t} kind {c % kinds if t > 1 else 0} é𝒳"))
    return data


AWKWARD = [
    (1, None, None, None), (1, None, None, None), (1, None, "user", ""), (1, 5, "user", "x"), (1, 5, "user", "x"), (1, 5, "a", "z"),
    (100, 0, "user", "hi"), (100, 1, None, "there"), (100, 2, "user", None), (101, 0, "user", "w" * 100_000), (105, 7, "b", "\x00\n,"),
    (None, 1, "user", "nobody's"), (-7, 0, "user", "hi"), (-100, 0, "user", "hi"), (2, 3, "user", "only"), (300, 0, "", ""), (2**52, 0, "user", "hi"),
]


def test_small_table(spark, small):
    df = spark.read.parquet(f"{small}/conversations.parquet")
    got = trie.prefix_trie(df)
    assert rows(got) == sql_rows(trie.OP12_SQL, conversations=as_table(df))
    assert sorted((tuple(r[c] for c in OUT) for r in got.collect()), key=str) == plain([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


def test_against_lists_of_turns(spark):
    check(spark, talk())


def test_awkward_rows(spark):
    df = check(spark, AWKWARD)
    assert rows(trie.prefix_trie(df)) == sql_rows(trie.OP12_SQL, conversations=as_table(df))


def test_empty(spark):
    assert found(spark.createDataFrame([], TURNS)) == []
    assert found(spark.createDataFrame([(None, 1, "user", "x")], TURNS)) == []


def test_turnless_conversations_are_members_of_the_root(spark):
    ids = [c for c in range(1, 400) if zlib.crc32(str(c).encode()) % 6 and c % 100][:3]
    assert found(spark.createDataFrame([(c, 0, "user", "gone") for c in ids], TURNS)) == plain([(c, 0, "user", "gone") for c in ids])


def test_clashing_columns(spark):
    df = spark.createDataFrame(talk(40), TURNS)
    more = df.withColumns({c: F.lit("x") for c in ("c", "d", "pos", "row", "ref", "f0", "weight", "_range", "chars")})
    assert found(more) == found(df)


def test_collisions_are_noticed_and_mended(spark, monkeypatch):
    """Primes so small that different prefixes meet: the first attempts fail, the result is right."""
    seen = []
    built = trie.rebuilt
    monkeypatch.setattr(trie, "rebuilt", lambda turns, moduli, *how: seen.append(moduli) or built(turns, moduli, *how))
    check(spark, talk(60), moduli=((11,), (101,), *trie.MODULI))
    assert seen == [(11,), (101,), *trie.MODULI]
    with pytest.raises(RuntimeError):
        trie.prefix_trie(spark.createDataFrame(talk(60), TURNS), moduli=((5,),), attempts=2)


def test_blocks_ranges_and_joined_lookups(spark, monkeypatch):
    from burnish.operators import skew

    monkeypatch.setattr(trie, "BLOCK_BITS", 1)
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    check(spark, talk(120))


def test_hot_conversation_and_hot_ending(spark):
    """A third of the turns in one conversation, a third of the conversations equal."""
    data = [(0, t, "user", f"long {t % 50}") for t in range(600)]
    data += [(100 + c, t, "user", f"same {t}") for c in range(100) for t in range(6)]
    data += [(1_000 + c, t, "user", f"{c} {t}") for c in range(60) for t in range(4)]
    check(spark, data)


def test_ends_of_one_node_over_many_ranges(spark):
    """The list of a node's ids is hashed piece by piece, in order."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ends = spark.range(-500, 20_000).select((F.col("id") % 1_000 == 0).cast("long").alias("d"), F.lit(0).cast("long").alias("f0"), F.col("id").alias("c"))
        got = {r.d: r.ends_sha256 for r in trie.ends_digest(ends, ["d", "f0"]).collect()}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for d in (0, 1):
        ids = ",".join(str(c) for c in range(-500, 20_000) if (c % 1_000 == 0) == bool(d))
        assert got[d] == hashlib.sha256(ids.encode()).hexdigest()


def test_powers(spark):
    exponents = [0, 1, 2, 31, 4096, 123_456_789, 2**32 - 1]
    p = trie.MODULI[0][0]
    got = spark.createDataFrame([(x,) for x in exponents], "x long").select("x", trie._power(F.col("x"), 48_271, p).alias("y")).collect()
    assert all(r.y == pow(48_271, r.x, p) for r in got)
