"""Comparison helpers and the awkward rows every operator must take."""

import duckdb
import pandas as pd

DOCS = "doc_id long, text string, lang string, source string, n_chars long"

AWKWARD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, "   \t\n ", "en", None, 6),
    (4, "One two three four five.", "en", "a", 24),
    (4, "One two three four five.", "en", "a", 24),
    (5, "one two three four five.", "de", "b", 24),
    (None, "no id at all here", "fr", "b", 17),
    (None, None, None, None, None),
    (6, "word " * 30_000, "en", "c", 150_000),
    (7, "x" * 50_000, "en", "c", 50_000),
    (8, "日本語 のテキスト é ü 𝒳 1.2.3.4", "ja", "c", 24),
]


def rows(df) -> list[tuple]:
    names = sorted(df.columns)
    found = [tuple(r[n] for n in names) for r in df.collect()]
    return sorted(found, key=lambda r: tuple((v is None, str(v)) for v in r))


def sql_rows(sql: str, **tables) -> list[tuple]:
    con = duckdb.connect()
    for name, rows_ in tables.items():
        con.register(name, rows_)
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(r[i] for i in order) for r in found.fetchall()), key=lambda r: tuple((v is None, str(v)) for v in r))


def as_table(df):
    return df.toArrow()


def frame(data, columns) -> pd.DataFrame:
    return pd.DataFrame(data, columns=columns)
