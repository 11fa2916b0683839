"""Wrong-language text by letter trigrams, learnt from the columns themselves.

Function words do not help with names and titles, which hold none.  Here the values of each
language (a column per language, or a declared code per row) are counted by trigram, and a
value is judged by the log likelihoods its trigrams have in each language: it is in the
wrong one if another is likelier by more than a margin.  Most values of a column have to be
right; languages come from the data, so any script and any number of them will do.

Every distinct value is judged once.  Trigrams are counted map-side, the model comes to them
by a measured broadcast or a salted join, and so do the verdicts to the rows.  Scores are whole
thousandths of a natural logarithm, so sums do not depend on their order.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from burnish.operators.skew import attach, is_small
from burnish.session import materialise

UNIT = 1000  # scores are in 1 / UNIT of a natural logarithm
MARGIN = 3 * UNIT  # another language must be e ** 3, about 20 times, as likely


def normalised(value: Column) -> Column:
    """Lower case, runs of other characters than letters as one space, a space at either end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(value), r"[^\p{L}\p{M}]+", " ")), F.lit(" "))


def trigrams(value: Column) -> Column:
    """All trigrams of the normalised value; none for a value without letters."""

    def of(chars: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(chars) - 3), lambda i: F.concat(chars[i], chars[i + 1], chars[i + 2]))
        return F.when(F.size(chars) > 2, each).otherwise(F.array().cast("array<string>"))

    # The characters are bound once, so the work grows with the text and not with its square.
    return F.transform(F.array(F.split(normalised(value), "")), of)[0]


def distinct_values(df: DataFrame, value: str, label: str) -> DataFrame:
    """(label, value, n): every value with the language it is declared to be in, counted once."""
    known = df.select(F.col(label).alias("label"), F.col(value).alias("value")).filter("label IS NOT NULL AND value IS NOT NULL")
    return known.groupBy("label", "value").agg(F.count(F.lit(1)).alias("n"))


def column_values(df: DataFrame, languages: dict[str, str]) -> DataFrame:
    """The same for a table with a column per language."""
    cells = F.array(*[F.struct(F.lit(lang).alias("label"), F.col(f"`{c}`").alias("value")) for c, lang in languages.items()])
    return distinct_values(df.select(F.inline(cells)), "value", "label")


def learn(values: DataFrame) -> tuple[DataFrame, dict[str, int]]:
    """(gram, gains) and the score of an unseen trigram per language.

    With n of the N trigrams of a language and V distinct ones in all, a trigram's share is
    (2 n + 1) / (2 N + V); its gain is what it scores above an unseen one.  ``gains`` has an
    entry per language, in the order of their codes.
    """
    grams = values.select("label", "n", F.explode(trigrams(F.col("value"))).alias("gram")).groupBy("label", "gram").agg(F.sum("n").alias("n"))
    grams = materialise(grams, "trigrams")
    distinct = grams.select("gram").distinct().count()
    totals = {r.label: r.n for r in grams.groupBy("label").agg(F.sum("n").alias("n")).collect()}  # a row per language
    if not totals:
        return grams.select("gram", F.array("n").alias("gains")), {}
    wide = {label: 2 * n + distinct for label, n in totals.items()}
    unseen = {r.label: r.score for r in values.sparkSession.createDataFrame(list(wide.items()), "label string, wide bigint").select("label", _score(F.lit(1), F.col("wide")).alias("score")).collect()}
    by_label = F.create_map(*[F.lit(x) for label in totals for x in (label, wide[label])])
    floor = F.create_map(*[F.lit(x) for label in totals for x in (label, unseen[label])])
    gain = _score(2 * F.col("n") + 1, by_label[F.col("label")]) - floor[F.col("label")]
    each = [F.coalesce(F.max(F.when(F.col("label") == label, gain)), F.lit(0)).alias(f"g{i}") for i, label in enumerate(sorted(unseen))]
    return grams.groupBy("gram").agg(*each).select("gram", F.array(*[f"g{i}" for i in range(len(each))]).alias("gains")), unseen


def _score(part: Column, whole: Column) -> Column:
    return F.round(F.ln(part.cast("double") / whole.cast("double")) * UNIT).cast("bigint")


def judge(values: DataFrame, model: DataFrame, unseen: dict[str, int], margin: int = MARGIN) -> DataFrame:
    """(label, value, n, guess, lead, wrong): the likeliest language and by how much it leads the declared one.

    A value without letters, or declared in a language the model lacks, is not judged: no guess, not wrong.
    """
    if not unseen:
        return values.select("*", F.lit(None).cast("string").alias("guess"), F.lit(None).cast("bigint").alias("lead"), F.lit(False).alias("wrong"))
    texts = materialise(values.groupBy("value").agg(F.count(F.lit(1)).alias("labels")).select("value", F.monotonically_increasing_id().alias("id")), "texts")
    names = sorted(unseen)
    # A text's trigrams follow each other, so their sums are complete before the shuffle.
    scored = attach(texts.select("id", F.explode(trigrams(F.col("value"))).alias("gram")), model, ["gram"])
    gains = [F.sum(F.coalesce(F.col("gains")[i], F.lit(0))).alias(f"gain{i}") for i in range(len(names))]
    found = scored.groupBy("id").agg(F.count(F.lit(1)).alias("size"), *gains)
    total = lambda label: F.col("size") * F.lit(unseen[label]) + F.col(f"gain{names.index(label)}")
    best = F.greatest(*[F.struct(total(n).alias("score"), F.lit(-i).alias("i"), F.lit(n).alias("label")) for i, n in enumerate(names)]) if len(names) > 1 else F.struct(total(names[0]).alias("score"), F.lit(0).alias("i"), F.lit(names[0]).alias("label"))
    scores = F.create_map(*[x for n in names for x in (F.lit(n), total(n))])
    per_text = texts.join(found, "id").select("value", best.alias("best"), scores.alias("scores"))
    judged = attach(values, per_text, ["value"])
    lead = F.col("best.score") - F.col("scores")[F.col("label")]
    return judged.select("label", "value", "n", F.when(lead.isNotNull(), F.col("best.label")).alias("guess"), lead.alias("lead"), F.coalesce(lead > margin, F.lit(False)).alias("wrong"))


def flag_wrong_names(df: DataFrame, languages: dict[str, str], margin: int = MARGIN, label: str = "WRONG_LANGUAGE") -> DataFrame:
    """``<column>_flag`` for each column whose value is likelier in another column's language."""
    values = materialise(column_values(df, languages), "values")
    model, unseen = learn(values)
    wrong = materialise(judge(values, model, unseen, margin).filter("wrong").select("label", "value"), "wrong")
    small = is_small(wrong)

    def flag(frame: DataFrame, column: str) -> DataFrame:
        mark = f"_wrong_{column}"
        found = wrong.filter(F.col("label") == languages[column]).select(F.col("value").alias(column), F.lit(True).alias(mark))
        marked = frame.join(F.broadcast(found), [column], "left").select(*frame.columns, mark) if small else attach(frame, found, [column])
        return marked.withColumn(f"{column}_flag", F.when(F.col(f"`{mark}`"), F.lit(label))).drop(mark)

    return reduce(flag, languages, df)
