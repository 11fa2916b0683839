"""Does a text match the language its column or row declares?"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from burnish.functions.numbers import holds

# Script classes, and common function words of Latin-script languages.
SCRIPTS = {
    "hi": r"\p{IsDevanagari}",
    "ja": r"[\p{IsHiragana}\p{IsKatakana}\p{IsHan}]",
    "zh": r"\p{IsHan}",
    "ru": r"\p{IsCyrillic}",
    "ar": r"\p{IsArabic}",
}
FUNCTION_WORDS = {
    "de": ["der", "die", "das", "und", "ist", "nicht", "ein", "eine", "mit", "für", "auf", "zu", "den", "von"],
    "en": ["the", "and", "of", "to", "is", "in", "that", "with", "for", "it", "are", "was", "by", "this"],
    "es": ["el", "los", "las", "y", "es", "una", "con", "por", "para", "del", "al", "lo", "como", "pero"],
    "fr": ["le", "les", "et", "est", "une", "dans", "qui", "pour", "pas", "du", "au", "sur", "elle", "ce"],
}


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once however often it is read."""
    return F.transform(F.array(value), use)[0]


def guess_language(text: Column) -> Column:
    """Latin-script language with most function words in the whole text.

    NULL when it has none; the first code in order on a tie.
    """
    langs = sorted(FUNCTION_WORDS)
    known = sorted({w for words in FUNCTION_WORDS.values() for w in words})
    words = F.split(F.lower(text), r"[^\p{L}]+")
    # The array of known words is short and bound once, then counted per language.
    hits = F.filter(words, lambda w: w.isin(known))

    def count(found: Column, lang: str) -> Column:
        return F.size(F.filter(found, lambda w: w.isin(FUNCTION_WORDS[lang])))

    def best(found: Column) -> Column:
        return F.greatest(
            *[
                F.struct(count(found, lang).alias("n"), F.lit(-i).alias("i"), F.lit(lang).alias("lang"))
                for i, lang in enumerate(langs)
            ]
        )

    return _bind(_bind(hits, best), lambda top: F.when(top["n"] > 0, top["lang"]))


def wrong_language(text: Column, lang: Column | str) -> Column:
    """Script test for non-Latin languages, function words for Latin ones."""
    declared = lang if isinstance(lang, Column) else F.lit(lang)
    letters = text.rlike(r"\p{L}")
    script = [
        F.when(declared == code, letters & ~text.rlike(pattern)) for code, pattern in SCRIPTS.items()
    ]
    latin = F.when(
        declared.isin(sorted(FUNCTION_WORDS)), _bind(guess_language(text), lambda g: g.isNotNull() & (g != declared))
    )
    return holds(F.coalesce(reduce(lambda a, b: F.coalesce(a, b), script), latin))
