"""Text expressions: trimming, patterns, vocabularies, identifier formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The formats results are defined by.
WHITESPACE = " \t\n\x0b\f\r"
EMAIL = r"^[^@]+@[^@]+\.[^@]+$"
LIKE_EMAIL = "%@%.%"
ACCOUNT_CODE = r"(?s)^(?:GL-)?(?:0(?=[0-9]{4}))?(.*?)(?:-00)?$"
TAG = r"<[^>]+>"
CONTROL_OR_REPLACEMENT = r"[\x{0080}-\x{009F}\x{FFFD}]"


def trim_ws(c: Column) -> Column:
    """Strip whitespace of every kind (tabs and newlines too) at both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def upper(c: Column) -> Column:
    return F.upper(c)


def lower(c: Column) -> Column:
    return F.lower(c)


def title_case(c: Column) -> Column:
    return F.initcap(c)


def map_values(c: Column, mapping: dict[str, str]) -> Column:
    """Exact-value map; anything else is upper-cased; NULL stays NULL."""
    pairs = [F.lit(x) for item in mapping.items() for x in item]
    return F.coalesce(F.create_map(*pairs)[c], F.upper(c)) if pairs else F.upper(c)


def standardise_rule(c: Column, synonyms: dict[str, list[str]]) -> Column:
    """TRIM + UPPER, then every listed synonym becomes its canonical value."""
    value = F.upper(trim_ws(c))
    out = value
    for canonical, words in synonyms.items():
        out = F.when(value.isin(words), F.lit(canonical)).otherwise(out)
    return out


def valid_email(c: Column) -> Column:
    return c.rlike(EMAIL)


def like_email(c: Column) -> Column:
    return c.like(LIKE_EMAIL)


def clean_email(c: Column) -> Column:
    """Lower-case when well formed, NULL otherwise."""
    return F.when(valid_email(c), F.lower(c))


def clean_phone(c: Column, country: str = "1") -> Column:
    """E.164 where the digits allow it, otherwise the value as it was.

    A leading ``+`` or ``00`` marks an international number of 8 to 15 digits; ten
    bare digits are taken as a national number of ``country``.
    """
    digits = F.regexp_replace(c, "[^0-9]", "")
    n = F.length(digits)
    trimmed = F.trim(c)
    plain = c.rlike(r"^[0-9+() .\-]+$")
    return (
        F.when(plain & trimmed.startswith("+") & n.between(8, 15), F.concat(F.lit("+"), digits))
        .when(
            plain & trimmed.startswith("00") & n.between(10, 17),
            F.concat(F.lit("+"), F.substr(digits, F.lit(3))),
        )
        .when(plain & (n == 10), F.concat(F.lit(f"+{country}"), digits))
        .when(
            plain & (n == 10 + len(country)) & digits.startswith(country), F.concat(F.lit("+"), digits)
        )
        .otherwise(c)
    )


def matches(c: Column, regex: str) -> Column:
    return c.rlike(regex)


def strip_tags(c: Column) -> Column:
    return trim_ws(F.regexp_replace(c, TAG, ""))


def strip_html(c: Column) -> Column:
    """Remove tags; a value without ``<`` is left exactly as it is."""
    return F.when(c.contains("<"), strip_tags(c)).otherwise(c)


def has_text(c: Column, part: str) -> Column:
    return c.contains(part)


def starts(c: Column, prefix: str) -> Column:
    return c.startswith(prefix)


def replace_text(c: Column, old: str, new: str) -> Column:
    return F.replace(c, F.lit(old), F.lit(new))


def zfill_trunc(c: Column, width: int = 4) -> Column:
    """Zero-pad on the left to ``width``; longer values keep their first characters."""
    return F.lpad(c, width, "0")


def id_suffix(c: Column, separator: str = "-") -> Column:
    """Number after the first separator of an identifier; NULL when it is not a number."""
    return F.get(F.split(c, separator), F.lit(1)).try_cast("int")


def make_id(prefix: str, c: Column, width: int) -> Column:
    return F.concat(F.lit(prefix), F.lpad(c.cast("string"), width, "0"))


def first_word(c: Column) -> Column:
    return F.element_at(F.split(trim_ws(c), r"\s+"), 1)


def last_word(c: Column) -> Column:
    return F.element_at(F.split(trim_ws(c), r"\s+"), -1)


def clean_version(c: Column, semver: bool = False) -> Column:
    """Version text to ``v<dotted>``; ``semver`` also pads to three parts."""
    value = F.lower(trim_ws(c))
    value = F.replace(F.replace(value, F.lit("version "), F.lit("v")), F.lit("_"), F.lit("."))
    value = F.when(value.startswith("v"), value).otherwise(F.concat(F.lit("v"), value))
    if not semver:
        return value
    dots = F.length(value) - F.length(F.replace(value, F.lit("."), F.lit("")))
    return F.when(dots == 0, F.concat(value, F.lit(".0.0"))).when(
        dots == 1, F.concat(value, F.lit(".0"))
    ).otherwise(value)


def clean_account_code(c: Column) -> Column:
    """Account code to four digits: no ``GL-`` prefix, ``-00`` suffix or extra zero."""
    core = F.regexp_extract(F.upper(trim_ws(c)), ACCOUNT_CODE, 1)
    return zfill_trunc(core, 4)


def null_tokens(c: Column, tokens: list[str]) -> Column:
    return F.when(~c.isin(tokens), c)


def padded(c: Column) -> Column:
    return c != trim_ws(c)


def has_markup(c: Column) -> Column:
    return c.rlike(TAG)


def bad_encoding(c: Column) -> Column:
    """C1 control or replacement characters: the marks of a broken decode."""
    return c.rlike(CONTROL_OR_REPLACEMENT)
