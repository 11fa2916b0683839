"""Language identification by words first, with back-off to shorter and shorter n-grams.

The model holds, per language, log frequencies of words and of character n-grams.  A known
word is scored by its own frequencies.  An unseen word is scored by its longest known
n-grams: all of length 4, else 3, else 2, else single characters (with marks for the word's
ends).  Every word of the whole text counts; the language with the largest sum is returned.

The frequencies are learnt on a sample of about ``per_language`` documents of each language
(a hash of the id decides; all documents if there are fewer) and counted by Spark.  Each
language brings its own most frequent words, and as many n-grams: ``cells / languages``, at
least ``EACH``, where the last count that fits in part gives a share picked by hash.  What is
broadcast grows with the languages, not with the table, and no language is crowded out; a row
names only the languages the gram was seen in.  Rarer words are unseen words.

Defined cases: a null text, or one without letters, is ``und`` with score 0; equal sums go
to the language that sorts first; without any training row all documents are ``und``;
repeated rows are each predicted; input columns named like an added one are replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from burnish.llm.common import held_out, small_batches
from burnish.session import materialise

PER_LANGUAGE = 1_500
CELLS = 400_000
EACH = 5_000  # words, and n-grams, that a language brings at least
LONGEST = 4
UNKNOWN = "und"
SPREAD = 16_000_000  # cells up to which a task spreads a model table out
CACHE = 100_000  # words whose scores a task remembers
_WORDS = re.compile(r"[^\W\d_]+")  # runs of letters, and of numerals that are no digits


def _words(text: str) -> Counter[str]:
    """Runs of letters of a lower-case text; fractions, Roman and circled numerals are none."""
    words = Counter(_WORDS.findall(text))
    for odd in [w for w in words if not w.isalpha()]:
        times = words.pop(odd)
        for run in "".join(c if c.isalpha() else " " for c in odd).split():
            words[run] += times
    return words


def _top(grams: DataFrame, most: int) -> DataFrame:
    """All counts (lang, gram, n) of the grams that are among about the ``most`` most frequent of some language."""
    cuts, room = [], {}
    # Distinct counts of a language are few: their sum is at most the sample's words.
    for r in grams.groupBy("lang", "n").agg(F.count(F.lit(1)).alias("grams")).orderBy("lang", F.col("n").desc()).collect():
        left = room.setdefault(r.lang, most)
        if left > 0:
            cuts.append((r.lang, r.n, min(1.0, left / r.grams)))
            room[r.lang] = left - r.grams
    kept = grams.sparkSession.createDataFrame(cuts, "lang string, n long, share double")
    chance = F.pmod(F.xxhash64(F.lit("gram"), "gram"), F.lit(1_000_000)) / 1e6
    own = F.coalesce(chance < F.col("share"), F.lit(False))
    # One entry for each language that has the gram.
    whole = grams.join(F.broadcast(kept), ["lang", "n"], "left").groupBy("gram").agg(F.max(own).alias("own"), F.collect_list(F.struct("lang", "n")).alias("all"))
    return whole.filter("own").select("gram", F.inline("all"))


def _frequencies(counts: DataFrame, langs: list[str]) -> tuple[dict, tuple]:
    """Row of each gram, and its log frequencies (see ``_reader``)."""
    found = counts.select("gram", "lang", "n").toArrow().to_pandas()
    found["lang"] = found["lang"].map({x: i for i, x in enumerate(langs)})
    found = found.sort_values(["gram", "lang"], ignore_index=True)
    grams, starts = np.unique(found["gram"].to_numpy(object).astype(object), return_index=True) if len(found) else (np.array([]), np.array([], np.int64))
    lang, n = found["lang"].to_numpy(np.int32), found["n"].to_numpy(np.float64)
    totals = np.bincount(lang, n, len(langs)) + 0.5 * len(grams)
    floor = np.log(0.5 / np.maximum(totals, 0.5)).astype(np.float32)
    seen = np.log((n + 0.5) / totals[lang]).astype(np.float32)
    return {g: i for i, g in enumerate(grams)}, (floor, np.append(starts, len(found)), lang, seen)


def _plain(rows) -> np.ndarray | None:
    """The plain table, unless it is too large to spread out."""
    if isinstance(rows, np.ndarray):
        return rows
    floor, starts, lang, seen = rows
    if (len(starts) - 1) * len(floor) > SPREAD:
        return None
    out = np.repeat(floor[None], len(starts) - 1, axis=0)
    out[np.repeat(np.arange(len(starts) - 1), np.diff(starts)), lang] = seen
    return out


def _reader(rows):
    """From row numbers to log frequencies of all languages.

    ``rows`` is a plain table, or what unseen grams have in each language, the start of each
    row, and by row the languages the gram was seen in with their log frequencies.
    """
    if (plain := _plain(rows)) is not None:
        return lambda at: plain[at]
    floor, starts, lang, seen = rows

    def read(at: list[int]) -> np.ndarray:
        out = np.repeat(floor[None], len(at), axis=0)
        for i, row in enumerate(at):
            own = slice(starts[row], starts[row + 1])
            out[i, lang[own]] = seen[own]
        return out

    return read


def learn(rows: DataFrame, per_language: int = PER_LANGUAGE, cells: int = CELLS) -> dict:
    """Rows (doc_id, text, lang) -> languages, vocabulary and log frequencies."""
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    # One row per language: the label set, which the model holds anyway.
    counts = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    langs = sorted(counts)
    if not langs:
        return {"langs": []}
    spark = rows.sparkSession
    shares = spark.createDataFrame([(x, min(1.0, per_language / counts[x])) for x in langs], "lang string, share double")
    chance = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1_000_000)) / 1e6
    sample = rows.join(F.broadcast(shares), "lang").filter(chance < F.col("share"))
    words = sample.select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit("\\p{L}+"), F.lit(0))).alias("gram"))
    words = materialise(words.groupBy("lang", "gram").agg(F.count(F.lit(1)).alias("n")), "langid-words")
    most = max(EACH, cells // len(langs))
    model = {"langs": langs, "tables": []}
    padded = F.concat(F.lit("^"), F.col("gram"), F.lit("$"))
    pieces = F.flatten(F.array(*[F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - k + 1)), lambda i, k=k: F.substr(padded, i, F.lit(k))) for k in range(1, LONGEST + 1)]))
    parts = materialise(words.select("lang", F.explode(pieces).alias("gram"), "n").groupBy("lang", "gram").agg(F.sum("n").alias("n")), "langid-grams")
    for grams in (words, parts):
        model["tables"].append(_frequencies(_top(grams, most), langs))
    return model


def _scorer(model: dict):
    (known, word_rows), (grams, gram_rows) = model["tables"]
    langs = model["langs"]
    plain, read_grams = _plain(word_rows), _reader(gram_rows)
    read_words = _reader(word_rows) if plain is None else None
    met: dict[str, int] = {}
    room = np.zeros((CACHE, len(langs)), np.float32)
    table = room if plain is None else np.concatenate((plain, room))
    base = len(table) - CACHE

    def back_off(word: str) -> np.ndarray:
        marked = f"^{word}$"
        for size in range(min(LONGEST, len(marked)), 0, -1):
            found = [grams[g] for g in (marked[i : i + size] for i in range(len(marked) - size + 1)) if g in grams]
            if found:
                return read_grams(found).mean(axis=0)
        return np.zeros(len(langs), np.float32)

    def row(word: str) -> int:
        own = known.get(word)
        if own is not None and read_words is None:
            return own
        if (at := met.get(word)) is None:
            at = met[word] = base + len(met)
            table[at] = back_off(word) if own is None else read_words([own])[0]
        return at

    def score(text: str | None) -> tuple[str, float]:
        words = _words((text or "").lower())
        if not words:
            return UNKNOWN, 0.0
        total, listed = np.zeros(len(langs)), list(words)
        for at in range(0, len(listed), CACHE // 2):
            part = listed[at : at + CACHE // 2]
            if len(met) + len(part) > CACHE:
                met.clear()
            total += np.array([words[w] for w in part], np.float64) @ table[[row(w) for w in part]]
        spread = np.exp((total - total.max()) / np.sqrt(sum(words.values())))
        best = int(total.argmax())
        return langs[best], float(spread[best] / spread.sum())

    return score


def predict(model: dict, text: Column, spark) -> Column:
    """Struct (lang_pred, score) of a text column."""
    if not model["langs"]:
        return F.struct(F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        score = _scorer(shared.value)
        for texts in batches:
            yield pd.DataFrame([score(t) for t in texts], columns=["lang_pred", "score"])

    return predicted(text)


def identify(docs: DataFrame) -> DataFrame:
    """All rows of ``docs`` with held_out, lang_pred and score; learns from the others' text and lang."""
    docs = small_batches(docs).select(*[c for c in docs.columns if c not in ("held_out", "lang_pred", "score")])
    model = learn(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    return docs.select("*", held_out().alias("held_out"), predict(model, F.col("text").cast("string"), docs.sparkSession).alias("_p")).select(*docs.columns, "held_out", "_p.lang_pred", "_p.score")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Documents in some language: those without a single letter go; columns as they are."""
    model = learn(docs.filter(~held_out()).select("doc_id", "text", "lang"))
    found = predict(model, F.col("text").cast("string"), docs.sparkSession)
    names = docs.columns
    return small_batches(docs).select(F.struct(*names).alias("_row"), found.alias("_p")).filter(F.col("_p.lang_pred") != UNKNOWN).select("_row.*")
