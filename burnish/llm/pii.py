"""Personal data by patterns and a skip-chain conditional random field.

Base spans come from four patterns with checks (see ``base_spans``).  The field then labels
the signal tokens of a document, those that hold a digit or an ``@``; all other words
are outside any entity and part the tokens into chains.  Potentials:

* a token's shape (digits, separators, parts, check digit, letters), log-linear;
* neighbouring tokens of a chain;
* skip edges between distant tokens that are equal or similar, that is, share their last seven
  digits, or are one address case-folded, or are equal to a short token that is a base span.
  Tokens that are alike are joined to one of them, the first that base spans hold, so edges
  grow with the tokens, not with their pairs, and no repeat is far from what the patterns found.

A number written in groups is one token if its groups together repeat the last seven digits of
a card or phone that the patterns found in the document; groups that share no digit with the
common end stay apart.

Tokens of base spans are observed.  Loopy message passing (damped, over a whole batch of
documents) carries their labels along the edges until a document's messages change by less
than ``SETTLED``, so an altered repeat of an identifier takes the label of the one the patterns
found.  A document whose loops swing stops after ``MOST`` looks at every ``ROUNDS`` rounds.
Tokens labelled as an entity that no base span touches become added spans.

Weights are fitted on the tokens of about ``FIT_ROWS`` documents (a hash of the id picks
them), with the base spans as labels; Spark counts shapes and label pairs first, so the
driver sees a table of distinct shapes, not tokens.  An unlabelled token that is like a
labelled one of its document counts as unknown, not as outside, in shapes and skip edges.

Defined cases: a null or empty text has no spans; overlapping spans of different kinds are all
reported, and masked as one; a table without any entity adds none; repeated rows are each
searched; very long texts are read whole in linear time.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.llm.common import small_batches

KINDS = ("email", "ip", "card", "phone")
FIT_ROWS = 3_000
ROUNDS = 8  # between two looks at whether messages have settled
MOST = 100
SETTLED = 1e-4
DAMPING = 0.5
SURE = 0.9  # belief an added token needs
OBSERVED = 8.0

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]\S*")
_DIGITS = re.compile(r"[^0-9]+")

Span = tuple[int, int, int]  # kind, start, end


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        total += n if i % 2 == 0 else n * 2 - 9 * (n > 4)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """Matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``, found from the @ outwards."""
    found, end, at = [], 0, text.find("@")
    last = -1
    while at >= 0:
        m = _DOMAIN.match(text, at)
        if m:
            floor = max(end, last + 1)
            start = floor + len(text[floor:at].rstrip(_LOCAL))
            if start < at:
                end = m.end()
                found.append((0, start, end))
        last = at
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str | None) -> list[Span]:
    """Leftmost non-overlapping matches of each kind that pass its check, by kind, then start."""
    text = text or ""
    found = _emails(text)
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) < 4 and int(p or 0) <= 255 for part in m[0].split(".")):
            found.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, m.start(), m.end()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.sub("", m[0])) <= 15:
            found.append((3, m.start(), m.end()))
    return found


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in sorted(spans))


def _tokens(text: str) -> list[tuple[int, int]]:
    """Extents of the words that hold a digit or an @."""
    found, end = [], 0
    for m in _SIGNAL.finditer(text):
        before = text[end : m.start()]
        start = m.start()
        if before and not before[-1].isspace():
            start -= len(before.rsplit(None, 1)[-1])
        end = m.end()
        found.append((start, end))
    return found


def _shape(word: str) -> int:
    """Bit mask of a token's features."""
    digits = _DIGITS.sub("", word)
    n = len(digits)
    bare = word.strip(".,;:!?\"'()[]<>|")
    parts = bare.split(".")
    size = 0 if n == 0 else 1 if n < 3 else 2 if n < 5 else 3 if n < 7 else 4 if n < 9 else 5 if n < 13 else 6 if n < 20 else 7
    letters = sum(c.isalpha() for c in word)
    mask = 1 << size
    mask |= ("@" in word) << 8 | ("." in bare.rpartition("@")[2]) << 9 | word.startswith("+") << 10 | ("(" in word) << 11
    mask |= (len(parts) == 4 and all(p.isdigit() and len(p) < 4 for p in parts)) << 12
    mask |= (6 == size and _luhn(digits)) << 13 | ("-" in bare) << 14
    mask |= (letters == 0) << 15 | (0 < letters <= n) << 16 | (letters > n) << 17 | (n == len(bare)) << 18
    return mask


FEATURES = 19


def _key(word: str) -> str:
    """What similar tokens share; empty for tokens too short to be told apart."""
    digits = _DIGITS.sub("", word)
    if "@" in word:
        return _bare(word)
    return digits[-7:] if len(digits) >= 7 else ""


def _bare(word: str) -> str:
    return word.lower().strip(".,;:!?\"'()[]<>|")


def _alike(a: str, b: str) -> int:
    """Length of the common end of two numbers."""
    n = 0
    while n < min(len(a), len(b)) and a[-1 - n] == b[-1 - n]:
        n += 1
    return n


def _joined(text: str, tokens: list[tuple[int, int]], own: list[Span]) -> list[tuple[int, int]]:
    """The tokens, neighbours that together repeat a card or phone of ``own`` (in order) as one."""
    numbers: dict[str, str] = {}
    for k, s, e in own:
        if k > 1:
            digits = _DIGITS.sub("", text[s:e])
            numbers.setdefault(digits[-7:], digits)
    if not numbers:
        return tokens
    found: list[tuple[int, int]] = []
    run: list[str] = []  # digits of the last tokens in ``found`` that may belong to one number
    at = 0
    for start, end in tokens:
        while at < len(own) and own[at][2] <= start:
            at += 1
        if run and not (start - found[-1][1] < 3 and text[found[-1][1] : start].isspace()):
            run = []
        found.append((start, end))
        word = text[start:end]
        if any(s < end and e > start for _, s, e in own[at : at + 4]) or "@" in word or any(c.isalpha() for c in word):
            run = []
            continue
        run = [*run[-19:], _DIGITS.sub("", word)]
        digits = "".join(run)
        if len(digits) >= 7 and (known := numbers.get(digits[-7:])):
            same, n, covered = _alike(digits, known), 1, len(run[-1])
            while covered < same and n < len(run) and covered + len(run[-n - 1]) <= len(known) + 4:
                n += 1
                covered += len(run[-n])
            found[-n:] = [(found[-n][0], end)]
            run[-n:] = ["".join(run[-n:])]  # a number of like digits may go on
    return found


def _graph(texts, spans: list[list[Span]]) -> tuple:
    """Tokens of many documents: owner, extents, shapes, observed labels; chain and skip edges."""
    owner, extent, shape, label, chain, skip = [], [], [], [], [], []
    for doc, (text, own) in enumerate(zip(texts, spans)):
        if not text:
            continue
        like: dict[str, list[int]] = {}
        equal: dict[str, list[int]] = {}  # tokens too short for a key
        last_end = -2
        own = sorted(own, key=lambda s: s[1])
        at = 0
        for start, end in _joined(text, _tokens(text), own):
            word, i = text[start:end], len(owner)
            while at < len(own) and own[at][2] <= start:
                at += 1
            near = [(k, s, e) for k, s, e in own[at : at + 4] if s < end and e > start]
            owner.append(doc)
            extent.append((start, end))
            shape.append(_shape(word))
            label.append(1 + min(near)[0] if near else 0)
            if last_end >= 0 and text[last_end:start].isspace() and start - last_end < 3:
                chain.append((i - 1, i))
            last_end = end
            key = _key(word)
            for k, s, e in near:
                if k > 1 and s < start and e <= end:  # a number in several words ends here
                    key = key or _DIGITS.sub("", text[s:e])[-7:]
            if key:
                like.setdefault(key, []).append(i)
            elif all(start <= s and e <= end for _, s, e in near):
                equal.setdefault(_bare(word), []).append(i)  # no part of a longer span
        for groups, seen_only in ((like, False), (equal, True)):
            for group in groups.values():
                hub = next((i for i in group if label[i]), None)
                if hub is not None or not seen_only:
                    hub = group[0] if hub is None else hub
                    skip += [(hub, i) for i in group if i != hub]
    pairs = lambda x: np.array(x, np.int64).reshape(-1, 2)
    return np.array(owner, np.int64), extent, np.array(shape, np.int64), np.array(label, np.int64), pairs(chain), pairs(skip)


def _bits(shapes: np.ndarray) -> np.ndarray:
    return ((shapes[:, None] >> np.arange(FEATURES)) & 1).astype(np.float64)


_COUNTS = T.StructType([T.StructField(c, T.LongType()) for c in ("kind", "a", "b", "n")])


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of (0, shape, label), (1, label, label) along chains and (2, label, label) along skips."""
    for rows in batches:
        texts = list(rows["text"])
        _, _, shape, label, chain, skip = _graph(texts, [base_spans(t) for t in texts])
        group = np.arange(len(shape))
        for a, b in skip.tolist():
            group[b] = group[a]
        known = np.zeros(len(shape), bool)
        known[group[label > 0]] = True
        sure = (label > 0) | ~known[group]
        parts = [np.stack((np.zeros_like(shape), shape, label), axis=1)[sure]]
        parts += [np.concatenate((np.full((len(e), 1), k), label[e]), axis=1) for k, e in ((1, chain), (2, skip[sure[skip].all(axis=1)]))]
        keys, n = np.unique(np.concatenate(parts), axis=0, return_counts=True)
        yield pd.DataFrame({"kind": keys[:, 0], "a": keys[:, 1], "b": keys[:, 2], "n": n})


def fit(docs: DataFrame, rows: int = FIT_ROWS) -> dict:
    """Potentials from (doc_id, text): weights by feature and label, chain and skip matrices."""
    total = docs.count()
    chance = F.pmod(F.xxhash64(F.lit("pii"), "doc_id"), F.lit(1_000_000)) / 1e6
    sample = small_batches(docs).filter(chance < rows / max(1, total)).select(F.col("text").cast("string").alias("text"))
    counts = sample.mapInPandas(_counted, _COUNTS).groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).orderBy("kind", "a", "b").collect()
    size = len(KINDS) + 1
    unary = [(r.a, r.b, r.n) for r in counts if r.kind == 0]
    weights, bias = np.zeros((FEATURES, size)), np.full(size, -6.0)
    bias[0] = 0.0
    if unary:
        shapes, labels, n = (np.array(x) for x in zip(*unary))
        x, y = _bits(shapes), np.eye(size)[labels]
        share = n[:, None] / n.sum()
        for _ in range(600):  # full-batch gradient with a small penalty; a few hundred distinct shapes
            z = x @ weights + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            step = share * (p - y)
            weights -= 8.0 * (x.T @ step + 1e-5 * weights)
            bias -= 8.0 * step.sum(axis=0)
    edges = []
    for kind in (1, 2):
        table = np.full((size, size), 0.5) + (4.0 * np.eye(size) if kind == 2 else 0.0)
        for r in counts:
            if r.kind == kind:
                table[r.a, r.b] += r.n
        table = (table + table.T) / table.sum() if kind == 2 else table / table.sum()
        table /= table.sum()
        edges.append(np.clip(np.log(table / (table.sum(axis=1)[:, None] * table.sum(axis=0))), -3, 3))
    return {"weights": weights, "bias": bias, "chain": edges[0], "skip": edges[1]}


def beliefs(shape: np.ndarray, label: np.ndarray, chain: np.ndarray, skip: np.ndarray, model: dict, owner: np.ndarray | None = None) -> np.ndarray:
    """Label probabilities of every token after loopy sum-product message passing; each ``owner`` settles by itself."""
    unary = _bits(shape) @ model["weights"] + model["bias"]
    unary -= unary.max(axis=1, keepdims=True)
    seen = label > 0
    unary[seen] -= OBSERVED
    unary[seen, label[seen]] += 2 * OBSERVED
    source = np.concatenate((chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]))
    target = np.concatenate((chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]))
    kinds = np.repeat([0, 1, 2, 3], [len(chain), len(chain), len(skip), len(skip)])
    tables = np.stack((model["chain"], model["chain"].T, model["skip"], model["skip"].T))
    reverse = np.concatenate((np.arange(len(chain)) + len(chain), np.arange(len(chain)), 2 * len(chain) + len(skip) + np.arange(len(skip)), 2 * len(chain) + np.arange(len(skip))))
    sent = np.zeros((len(source), unary.shape[1]))
    total = unary.copy()
    document = np.zeros(len(source), np.int64) if owner is None else owner[source]
    live = np.flatnonzero(~seen[target])  # what the patterns found is given, however many repeats it has
    for _ in range(MOST):
        if not len(live):
            break
        for _ in range(ROUNDS):
            out = total[source[live]] - sent[reverse[live]]
            new = np.log(np.exp(out[:, :, None] - out.max(axis=1)[:, None, None] + tables[kinds[live]]).sum(axis=1))
            new -= new.max(axis=1, keepdims=True)
            moved = DAMPING * sent[live] + (1 - DAMPING) * new
            change = np.abs(moved - sent[live]).max(axis=1)
            sent[live] = moved
            total = unary.copy()
            np.add.at(total, target, sent)
        moving = np.zeros(document.max() + 1, bool)
        moving[document[live[change > SETTLED]]] = True
        live = live[moving[document[live]]]
    p = np.exp(total - total.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _trimmed(text: str, start: int, end: int) -> tuple[int, int]:
    word = text[start:end]
    left = len(word) - len(word.lstrip(".,;:!?\"'[]<>|*#$%&"))
    right = len(word) - len(word.rstrip(".,;:!?\"'[]<>|*#$%&"))
    return start + left, end - right


def find(texts, model: dict) -> list[tuple[list[Span], list[Span]]]:
    """(base spans, added spans) of each text."""
    texts = [t or "" for t in texts]
    base = [base_spans(t) for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    owner, extent, shape, label, chain, skip = _graph(texts, base)
    if len(owner):
        p = beliefs(shape, label, chain, skip, model, owner)
        kind = p.argmax(axis=1)
        joined = set(chain[:, 1].tolist())
        last = -2
        for i in np.flatnonzero((label == 0) & (kind > 0) & (p.max(axis=1) >= SURE)).tolist():
            doc, k = int(owner[i]), int(kind[i]) - 1
            start, end = _trimmed(texts[doc], *extent[i])
            if start >= end:
                continue
            own = added[doc]
            if k == 3 and own and last == i - 1 and i in joined and own[-1][0] == k:
                own[-1] = (k, own[-1][1], end)  # a number written in several words
            else:
                own.append((k, start, end))
            last = i
    return list(zip(base, added))


def mask(text: str | None, spans: list[Span]) -> str | None:
    """The text with every span replaced by its kind; overlapping spans as one."""
    if text is None or not spans:
        return text
    out, at, held = [], 0, None
    for k, s, e in sorted(spans, key=lambda x: (x[1], -x[2], x[0])):
        if held and s < held[2]:
            held = (held[0], held[1], max(held[2], e))
            continue
        if held:
            out += [text[at : held[1]], f"[{KINDS[held[0]].upper()}]"]
            at = held[2]
        held = (k, s, e)
    out += [text[at : held[1]], f"[{KINDS[held[0]].upper()}]", text[held[2] :]]
    return "".join(out)


_FOUND = T.StructType([*[T.StructField(f"n_{k}", T.LongType()) for k in KINDS], T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, and all spans of every document."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs))

    @F.pandas_udf(_FOUND)
    def detected(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for base, added in find(texts, model.value):
                counts = [sum(k == i for k, _, _ in base) for i in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(written(base).encode()).hexdigest(), written([*base, *added])))
            yield pd.DataFrame(rows, columns=_FOUND.fieldNames())

    return small_batches(docs).select("doc_id", detected(F.col("text").cast("string")).alias("_p")).select("doc_id", "_p.*")


def masked(text: str, docs: DataFrame) -> Column:
    """The column with personal data masked, by a model fitted on ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs.select("doc_id", "text")))

    @F.pandas_udf(T.StringType())
    def cleaned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            texts = [None if t is None else t for t in texts]
            yield pd.Series([mask(t, [*b, *a]) for t, (b, a) in zip(texts, find(texts, model.value))], dtype=object)

    return cleaned(F.col(text).cast("string"))


def mask_documents(docs: DataFrame) -> DataFrame:
    """All documents, personal data masked in ``text``; ``n_chars``, if there, is counted anew."""
    done = small_batches(docs).withColumn("text", masked("text", docs))
    if "n_chars" in docs.columns:
        done = done.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return done.select(*docs.columns)
