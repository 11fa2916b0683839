import hashlib
import random
import re

from pyspark.sql import functions as F

from burnish.llm import pii
from burnish.llm.queries import QUERIES

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(map(int, str(2 * int(c)))) for i, c in enumerate(digits[::-1])) % 10 == 0


def plain(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 0 or kind == 1 and all(int(p) <= 255 for p in m[0].split(".")) or kind == 2 and 13 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 9 <= len(digits) <= 15:
                found.append((kind, m.start(), m.end()))
    return found


def text_of(spans):
    return ",".join(f"{pii.KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def test_base_spans_of_random_text():
    random.seed(2)
    parts = ["a", "b.c", "@", "@x", ".com", "1", "12", "255", "256", ".", "..", " ", "  ", "-", "+", "+1", "(", ")", "4111111111111111", "4111-1111 1111 1111", "+1 (212) 555-0123", "é", "\n", "_", "%", "001", "x@y.z"]
    for _ in range(20_000):
        text = "".join(random.choices(parts, k=random.randint(1, 14)))
        assert sorted(pii.base_spans(text)) == sorted(plain(text)), text


def test_long_runs_take_linear_time():
    for text in ("1" * 300_000, "1." * 200_000, "a" * 300_000, "a@" * 100_000, "+1 " * 100_000, "1 " * 200_000, "@" * 100_000):
        pii.base_spans(text)
        pii._tokens(text)


def test_small_table(spark, small):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    found = QUERIES["op1_pii_skip_chain"](spark, small).collect()
    assert len(found) == len(docs)
    for r in found:
        base = plain(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(text_of(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == i for k, _, _ in base) for i in range(4)]
        assert set(filter(None, text_of(base).split(","))) <= set(r.spans.split(","))


def test_skip_edges_carry_labels(spark):
    said = "call +1 (212) 555-0123 now {} and later write 212-555-0123 please"
    texts = [said.format("word " * n) for n in range(60)] + ["plain words 12 and 3.5 only"] * 60
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    model = pii.fit(docs)
    base, added = pii.find([texts[3]], model)[0]
    assert [k for k, _, _ in base] == [3]
    assert [texts[3][s:e] for _, s, e in added] == ["212-555-0123"]
    _, _, shape, label, chain, skip = pii._graph([texts[3]], [base])
    assert skip.tolist() == [[2, 3]]
    apart = pii.beliefs(shape, label, chain, skip[:0], model)
    assert pii.beliefs(shape, label, chain, skip, model)[3, 4] > apart[3, 4]
    assert pii.find(["plain words 12 and 3.5 only"], model)[0] == ([], [])


def test_messages_are_exact_on_a_tree():
    import itertools

    import numpy as np

    rng = np.random.default_rng(1)
    size, n = len(pii.KINDS) + 1, 4
    model = {"weights": rng.normal(size=(pii.FEATURES, size)), "bias": rng.normal(size=size), "chain": rng.normal(size=(size, size)), "skip": np.ones((size, size))}
    shape, label = rng.integers(0, 2**pii.FEATURES, n), np.zeros(n, np.int64)
    chain, skip = np.array([[0, 1], [1, 2]]), np.array([[2, 3]])
    model["skip"] = rng.normal(size=(size, size))
    pii_rounds, pii.ROUNDS = pii.ROUNDS, 60
    got = pii.beliefs(shape, label, chain, skip, model)
    pii.ROUNDS = pii_rounds
    unary = pii._bits(shape) @ model["weights"] + model["bias"]
    want = np.zeros((n, size))
    for y in itertools.product(range(size), repeat=n):
        w = np.exp(sum(unary[i, y[i]] for i in range(n)) + model["chain"][y[0], y[1]] + model["chain"][y[1], y[2]] + model["skip"][y[2], y[3]])
        for i in range(n):
            want[i, y[i]] += w
    assert np.allclose(got, want / want.sum(axis=1, keepdims=True), atol=1e-6)


def test_awkward_rows_and_masks(spark, awkward, nothing):
    assert pii.detect(awkward).count() == awkward.count()
    assert pii.detect(nothing).count() == 0
    done = pii.mask_documents(awkward.withColumn("_p", F.lit(1)))
    assert done.columns == [*awkward.columns, "_p"] and done.count() == awkward.count()
    assert done.filter("doc_id = 1").first().text is None
    assert pii.mask("a x@y.z b 1.2.3.4", plain("a x@y.z b 1.2.3.4")) == "a [EMAIL] b [IP]"
    assert pii.mask("abcdef", [(0, 1, 3), (3, 2, 4)]) == "a[EMAIL]ef"


def _added(texts, model):
    return [[t[s:e] for _, s, e in added] for t, (_, added) in zip(texts, pii.find(texts, model))]


def test_altered_repeats_in_groups_and_far_away():
    import numpy as np

    size = len(pii.KINDS) + 1
    bias = np.full(size, -1.0)
    bias[0] = 0.0
    model = {"weights": np.zeros((pii.FEATURES, size)), "bias": bias, "chain": np.zeros((size, size)), "skip": np.full((size, size), -2.0) + 4.0 * np.eye(size)}
    texts = [
        "call +49 30 1234 5678 now or later 030 1234 5678 please",
        "card 4111 1111 1111 1111 and again 4111  1111  1111 1111 there",
        "call +1 (212) 555-0123 now " + "then 212-555-0123 or word " * 60,
        "call +49 30 1234 5678 and in 2024 there were 12 of 1234 5679 units",
    ]
    assert _added(texts, model) == [["030 1234 5678"], ["4111  1111  1111 1111"], ["212-555-0123"] * 60, []]
    assert _added(texts[::-1], model) == _added(texts, model)[::-1]


def test_short_equal_tokens_are_joined():
    text = "host 10.0.0.1 and 10.0.0.1 or 212 then +1 (212) 555-0123"
    *_, label, _, skip = pii._graph([text], [pii.base_spans(text)])
    assert skip.tolist() == [[0, 1]] and label[:3].tolist() == [2, 2, 0]


def test_grouped_numbers_take_linear_time():
    for text in ("+49 30 1234 5678 x " + "1234 5678 " * 50_000, "+1 2 3 4 5 6 7 8 9 x " + "1 2 3 4 5 6 7 8 9 " * 20_000):
        pii._graph([text], [pii.base_spans(text)])
