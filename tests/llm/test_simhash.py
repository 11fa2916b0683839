import numpy as np
import pytest
import xxhash
from helpers import DOCS, rows

from burnish.llm import components, simhash


def plain(text):
    """Fingerprint bit by bit, as the contract words it."""
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\x0b", " ").replace("\x0c", " ").split(" ") if w]
    if not words:
        return 0
    parts = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(p.encode(), seed=42).intdigest() for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints):
    """Smallest reachable id by comparing all with all."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j, (_, b) in enumerate(prints[:i]):
            if (a ^ b).bit_count() <= 2:
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(prints):
        k = find(i)
        least[k] = min([x for x in (d, least.get(k)) if x is not None], default=None)
    return [least[find(i)] for i in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", "  ", "A", "a B", "a b c", "A b\tc\nd e", "é Ü x y", "w " * 40_000])
def test_fingerprint(text):
    assert simhash.simhash(text) & (2**64 - 1) == plain(text)


def test_small_table_and_awkward_rows(spark, small, awkward):
    for df in (spark.read.parquet(f"{small}/documents.parquet"), awkward):
        data = [(r.doc_id, plain(r.text)) for r in df.collect()]
        want = sorted((str((d, f"{f:016x}", c)) for (d, f), c in zip(data, groups(data))))
        got = simhash.near_duplicates(df).collect()
        assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want


def test_links_of_planted_neighbours(spark):
    rng = np.random.default_rng(3)
    base = [int(x) for x in rng.integers(0, 2**64, 40, dtype=np.uint64)]
    prints = list(base)
    for b in base:
        for flips in (1, 2, 2, 3):
            x = b
            for bit in rng.choice(64, flips, replace=False):
                x ^= 1 << int(bit)
            prints.append(x)
    chain = [base[0] ^ ((1 << k) - 1) for k in range(0, 64, 2)]  # each two bits from the next
    prints = sorted({*prints, *chain, 0, 2**64 - 1})
    signed = [x - 2**64 if x >= 2**63 else x for x in prints]
    edges = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"))
    found = {r.node: r.root for r in components.components(edges).collect()}
    want = groups(list(zip(signed, prints)))
    assert [found.get(x, x) for x in signed] == want


def test_keep_one(spark, awkward):
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    linked = simhash.near_duplicates(awkward)
    assert kept.count() == linked.select("component_id", "fingerprint").distinct().groupBy("component_id").count().count()
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(4) == 1 and 5 not in ids and 2 not in ids  # 1 stands for the wordless ones
    extra = awkward.selectExpr("*", "1 AS fp", "'x' AS component_id", "2 AS _h2")
    assert simhash.keep_one(extra).columns == extra.columns


def test_empty(nothing):
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_one(nothing).count() == 0


def test_long_chain_of_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 2001)], "a long, b long")
    found = {r.node: r.root for r in components.components(edges).collect()}
    assert all(found[i] == 0 for i in range(301)) and found[2001] == 2000 and 1000 not in found


def test_rows_of_one_id(spark):
    df = spark.createDataFrame([(5, "a b c d e f", "en", "s", 1), (5, "totally other words in here", "en", "s", 1), (3, "a b c d e f", "en", "s", 1)], DOCS)
    assert sorted(r.text for r in simhash.keep_one(df).collect()) == ["a b c d e f", "totally other words in here"]
    assert rows(simhash.keep_one(df.unionAll(df))) == rows(simhash.keep_one(df))
