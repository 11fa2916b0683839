"""Benchmark decontamination with an FM-index per training shard.

Every task turns its documents into shards of word ids and builds an FM-index of each:
suffix array, Burrows-Wheeler transform in a wavelet matrix, sampled suffix positions.  All
windows of the benchmark are searched backwards at once through wavelet ranks, occurrences
are located by walking to a sampled position, and the words they cover are merged into
removal spans.  Documents are never shuffled.

Words that occur in no window cannot be part of an occurrence, so they end a run, and runs
shorter than the shortest window are left out of the index; this changes no result.

A window is ``width`` consecutive words of an item; an item with fewer words is one window.
The benchmark is cut into pieces that overlap by ``width - 1`` words and dealt into blocks
of about ``block_words`` words by a count; a block is broadcast, and each block is one more
pass over the documents that adds to the spans found before.  So the broadcast is bounded
however large the benchmark is.

Defined cases: a null or wordless text has no words and is clean; a wordless item has no
window; a null item_id is the item "null"; items that repeat an id count once; repeated
documents are each judged; an empty benchmark marks nothing; input columns named like an
added column are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.llm.common import small_batches
from burnish.session import materialise

WIDTH = 13
WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
PIECE_WORDS = 2_000
BLOCK_WORDS = 200_000
SHARD_BYTES = 24 << 20
SAMPLE = 8  # every so many suffix positions are kept
SHARE = 20  # a document is contaminated if hits * SHARE >= words
ADDED = ("n_words", "hit_words", "hit_items", "spans")

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Bytes: A-Z lower-cased, other ASCII that is neither digit nor letter made a space.
_FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
_WORD = re.compile("[0-9A-Za-z\x80-\U0010ffff]+")


class FMIndex:
    """Full-text index of an int array; symbol 0 occurs once, at the end."""

    def __init__(self, text: np.ndarray, sample: int = SAMPLE):
        n = len(text)
        suffixes = _suffix_array(text)
        bwt = text[suffixes - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(text))))
        self.levels = []
        for bit in reversed(range(int(text.max()).bit_length() or 1)):
            on = (bwt >> bit) & 1
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(on, out=ones[1:])
            self.levels.append((bit, ones, n - int(ones[n])))
            bwt = np.concatenate((bwt[on == 0], bwt[on == 1]))
        self.n = n
        self.is_sampled = suffixes % sample == 0
        self.rank_sampled = np.concatenate(([0], np.cumsum(self.is_sampled)))
        self.sampled = suffixes[self.is_sampled]

    def occ(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before a place of the transform."""
        low = np.zeros_like(at)
        for bit, ones, zeros in self.levels:
            on = (symbols >> bit) & 1 == 1
            at = np.where(on, zeros + ones[at], at - ones[at])
            low = np.where(on, zeros + ones[low], low - ones[low])
        return at - low

    def back(self, rows: np.ndarray) -> np.ndarray:
        """Rows of the suffixes that start one symbol earlier."""
        symbols, at, low = np.zeros_like(rows), rows, np.zeros_like(rows)
        for bit, ones, zeros in self.levels:
            on = ones[at + 1] > ones[at]
            symbols |= on.astype(rows.dtype) << bit
            at = np.where(on, zeros + ones[at], at - ones[at])
            low = np.where(on, zeros + ones[low], low - ones[low])
        return self.first[symbols] + at - low

    def find(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Right-aligned patterns -> those that occur, first and end row of each."""
        which = np.arange(len(patterns))
        start, end = np.zeros(len(which), np.int64), np.full(len(which), self.n, np.int64)
        done = []
        for step in range(patterns.shape[1]):
            symbols = patterns[which, patterns.shape[1] - 1 - step]
            known = symbols < len(self.first) - 1
            which, start, end, symbols = which[known], start[known], end[known], symbols[known]
            start, end = self.first[symbols] + self.occ(symbols, start), self.first[symbols] + self.occ(symbols, end)
            whole = lengths[which] == step + 1
            alive = start < end
            done.append((which[alive & whole], start[alive & whole], end[alive & whole]))
            go = alive & ~whole
            which, start, end = which[go], start[go], end[go]
            if not len(which):
                break
        return tuple(np.concatenate(x) for x in zip(*done))

    def locate(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Text positions of all rows of the ranges, range after range."""
        counts = end - start
        rows = np.repeat(start - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
        positions, steps, open_ = np.empty(len(rows), np.int64), 0, np.arange(len(rows))
        while len(open_):
            there = self.is_sampled[rows]
            positions[open_[there]] = self.sampled[self.rank_sampled[rows[there]]] + steps
            open_, rows = open_[~there], rows[~there]
            rows = self.back(rows) if len(rows) else rows
            steps += 1
        return positions


def _suffix_array(text: np.ndarray) -> np.ndarray:
    """Prefix doubling: ranks by 1, 2, 4, ... symbols until all differ."""
    n, rank, step = len(text), text.astype(np.int64), 1
    order = np.argsort(rank, kind="stable")
    while True:
        values = rank[order]
        rank[order] = np.concatenate(([0], np.cumsum(values[1:] != values[:-1])))
        if rank[order[-1]] == n - 1:
            return order
        after = np.zeros(n, np.int64)
        after[: n - step] = rank[step:] + 1
        rank = rank * (n + 1) + after
        order = np.argsort(rank, kind="stable")
        step *= 2


def windows_of(pieces: list[tuple[str, list[str]]], width: int) -> SimpleNamespace:
    """The windows of one block of the benchmark: word ids, patterns, and the items of each."""
    vocabulary: dict[bytes, int] = {}
    items = sorted({item for item, _ in pieces})
    number = {item: i for i, item in enumerate(items)}
    found: dict[tuple, set[int]] = {}
    for item, words in pieces:
        ids = [vocabulary.setdefault(w.encode(), len(vocabulary) + 2) for w in words]
        for at in range(max(1, len(ids) - width + 1)):
            found.setdefault(tuple(ids[at : at + width]), set()).add(number[item])
    lengths = np.array([len(w) for w in found], np.int64)
    patterns = np.zeros((len(found), width), np.int64)
    for row, w in enumerate(found):
        patterns[row, width - len(w) :] = w
    listed = [sorted(x) for x in found.values()]
    owner_at = np.concatenate(([0], np.cumsum([len(x) for x in listed]))).astype(np.int64)
    owners = np.array([i for x in listed for i in x], np.int64)
    return SimpleNamespace(vocabulary=vocabulary, items=items, lengths=lengths, patterns=patterns, owner_at=owner_at, owners=owners, shortest=int(lengths.min()))


def _search(shard: list[np.ndarray], windows: SimpleNamespace) -> tuple[list[list[int]], list[list[int]]]:
    """For each document of a shard: covered words as flat start, end pairs, and item numbers."""
    sizes = np.array([len(x) for x in shard], np.int64)
    starts = np.concatenate(([0], np.cumsum(sizes + 1)))
    spans: list[list[int]] = [[] for _ in shard]
    items: list[list[int]] = [[] for _ in shard]
    ids = np.zeros(starts[-1] + 1, np.int64)  # a 0 ends each document
    for x, at in zip(shard, starts):
        ids[at : at + len(x)] = x
    edges = np.flatnonzero(np.diff(np.concatenate(([0], (ids > 0).astype(np.int8)))))
    run_start, run_end = edges[::2], edges[1::2]
    long = run_end - run_start >= windows.shortest
    mark = np.zeros(len(ids) + 1, np.int64)
    np.add.at(mark, run_start[long], 1)
    np.add.at(mark, run_end[long] + 1, -1)  # the 0 after a run stays as its end
    origin = np.flatnonzero(np.cumsum(mark[:-1]))
    if not len(origin):
        return spans, items
    text = np.append(np.maximum(ids[origin], 1), 0)
    index = FMIndex(text)
    which, start, end = index.find(windows.patterns, windows.lengths)
    if not len(which):
        return spans, items
    where = index.locate(start, end)
    which = np.repeat(which, end - start)

    cover = np.zeros(len(text) + 1, np.int64)
    np.add.at(cover, where, 1)
    np.add.at(cover, where + windows.lengths[which], -1)
    hit = np.zeros(len(ids) + 2, np.int8)
    hit[origin[np.flatnonzero(np.cumsum(cover)[: len(origin)])] + 1] = 1
    edges = np.flatnonzero(np.diff(hit))
    docs = np.searchsorted(starts, edges[::2], side="right") - 1
    for doc, s, e in zip(docs.tolist(), edges[::2].tolist(), edges[1::2].tolist()):
        spans[doc] += [s - int(starts[doc]), e - int(starts[doc])]

    docs = np.searchsorted(starts, origin[where], side="right") - 1
    pairs = np.unique(docs * len(windows.lengths) + which)
    docs, which = pairs // len(windows.lengths), pairs % len(windows.lengths)
    counts = windows.owner_at[which + 1] - windows.owner_at[which]
    at = np.repeat(windows.owner_at[which] - np.concatenate(([0], np.cumsum(counts)[:-1])), counts) + np.arange(counts.sum())
    pairs = np.unique(np.repeat(docs, counts) * len(windows.items) + windows.owners[at])
    for doc, item in zip((pairs // len(windows.items)).tolist(), (pairs % len(windows.items)).tolist()):
        items[doc].append(item)
    return spans, items


def _merged(old: list[int] | None, new: list[int]) -> list[int]:
    """Union of two lists of flat start, end pairs."""
    if not old or not new:
        return old or new
    out: list[int] = []
    both = sorted([*zip(old[::2], old[1::2]), *zip(new[::2], new[1::2])])
    for s, e in both:
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def char_spans(text: str | None, words: list[int]) -> str:
    """Word spans -> ``start:end`` code points of the text, comma-joined."""
    if not words:
        return ""
    places = [m.span() for m in _WORD.finditer(text or "")]
    return ",".join(f"{places[s][0]}:{places[e - 1][1]}" for s, e in zip(words[::2], words[1::2]))


def _marker(shared, names: list[str], keep: list[str], text: str, first: bool):
    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        known = windows.vocabulary.get
        held: list[tuple[pa.RecordBatch, list[np.ndarray]]] = []
        size = 0

        def flush():
            spans, items = _search([x for _, docs in held for x in docs], windows)
            at = 0
            for batch, docs in held:
                own, listed = spans[at : at + len(docs)], [[windows.items[i] for i in x] for x in items[at : at + len(docs)]]
                if not first:
                    own = [_merged(a, b) for a, b in zip(batch.column("hit_words").to_pylist(), own)]
                    listed = [sorted({*a, *b}) for a, b in zip(batch.column("hit_items").to_pylist(), listed)]
                texts = batch.column(text)
                chars = [char_spans(texts[i].as_py(), x) if x else "" for i, x in enumerate(own)]
                added = [
                    pa.array([len(x) for x in docs], pa.int64()),
                    pa.array(own, pa.list_(pa.int64())),
                    pa.array(listed, pa.list_(pa.string())),
                    pa.array(chars, pa.string()),
                ]
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], *added], [*keep, *ADDED])
                at += len(docs)
            held.clear()

        for batch in batches:
            docs = []
            for value in batch.column(text):
                words = (value.as_py() or "").encode().translate(_FOLD).split()
                docs.append(np.fromiter((known(w, 0) for w in words), np.int32, len(words)))
            held.append((batch, docs))
            size += batch.nbytes
            if size >= SHARD_BYTES:
                yield from flush()
                size = 0
        if held:
            yield from flush()

    return shards


def pieces(benchmark: DataFrame, width: int = WIDTH, piece: int = PIECE_WORDS) -> DataFrame:
    """(item, words): overlapping stretches of every item that together hold all its windows."""
    words = F.regexp_extract_all(F.translate(F.col("text").cast("string"), _UPPER, _LOWER), F.lit(WORD), F.lit(0))
    items = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item"), words.alias("w")).filter(F.size("w") > 0)
    last = F.greatest(F.lit(0), F.size("w") - width)
    starts = F.explode(F.sequence(F.lit(0), last, F.lit(piece))).alias("s")
    return items.select("item", "w", starts).select("item", F.slice("w", F.col("s") + 1, F.lit(piece + width - 1)).alias("words"))


def mark(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, text: str = "text", without: tuple = (), block_words: int = BLOCK_WORDS) -> DataFrame:
    """All rows of ``docs`` with ``n_words``, ``hit_words``, ``hit_items`` and character ``spans``."""
    spark = docs.sparkSession
    cut = materialise(pieces(benchmark, width).distinct(), "windows")  # copies of an item would share a block
    total = cut.agg(F.sum(F.size("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    names = [c for c in docs.columns if c not in ADDED]
    kept = [c for c in names if c not in without]
    fields = {f.name: f for f in docs.schema.fields}
    more = [T.StructField("n_words", T.LongType()), T.StructField("hit_words", T.ArrayType(T.LongType())), T.StructField("hit_items", T.ArrayType(T.StringType())), T.StructField("spans", T.StringType())]
    out = small_batches(docs).select(*names)
    if not total:
        size = F.coalesce(F.regexp_count(F.translate(F.col(text).cast("string"), _UPPER, _LOWER), F.lit(WORD)), F.lit(0)).cast("long")
        empty = [F.array().cast("array<bigint>"), F.array().cast("array<string>"), F.lit("")]
        return out.select("*", size.alias("n_words"), *[c.alias(n) for c, n in zip(empty, ADDED[1:])]).select(*kept, *ADDED)
    for block in range(blocks):
        rows = cut.filter(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block).collect()
        if not rows and blocks > 1:
            continue
        shared = spark.sparkContext.broadcast(windows_of([(r.item, r.words) for r in rows], width))
        keep = kept if block == blocks - 1 else names
        first = "hit_words" not in out.columns
        out = out.mapInArrow(_marker(shared, names, keep, text, first), T.StructType([*[fields[c] for c in keep], *more]))
    return out.select(*kept, *ADDED)


def judged(marked: DataFrame, share: int = SHARE) -> DataFrame:
    """Adds ``n_hit`` and ``contaminated`` to what ``mark`` returns."""
    n_hit = F.expr("aggregate(transform(hit_words, (x, i) -> IF(i % 2 = 0, -x, x)), 0L, (a, x) -> a + x)")
    marked = marked.withColumn("n_hit", n_hit)
    return marked.withColumn("contaminated", (F.col("n_hit") > 0) & (F.col("n_hit") * share >= F.col("n_words")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents that are not contaminated, as they are."""
    return judged(mark(docs, benchmark)).filter(~F.col("contaminated")).select(*docs.columns)


OP7_SQL = r"""
WITH dw AS (
  SELECT doc_id, row_number() OVER () AS rid,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
bw AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark),
win AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, array_to_string(w[i : i + 12], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM bw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM win),
dwin AS (
  SELECT rid, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT rid, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
occ AS (SELECT d.rid, d.i, d.n, b.item FROM dwin d JOIN win b ON d.n = b.n AND d.win = b.win),
hit AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT rid, i, n FROM occ)) GROUP BY rid),
its AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT rid, item FROM occ) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN hit USING (rid) LEFT JOIN its USING (rid)
"""
