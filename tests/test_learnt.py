"""Trigram language test, correlation matrix, and types of codes."""

import itertools

import pytest
from pyspark.sql import functions as F

from burnish.operators import gram, trigrams
from burnish.operators.profile import correlated_pairs, correlations
from burnish.sources import typing as Y

# Parts of product names in seven languages.
PARTS = {
    "de": (["Kabelloser", "Leichter", "Wasserdichter", "Großer", "Tragbarer", "Elektrischer", "Robuster"], ["Kopfhörer", "Rucksack", "Staubsauger", "Wasserkocher", "Lautsprecher", "Schraubenzieher", "Regenschirm"]),
    "fr": (["Nouveau", "Petit", "Grand", "Léger", "Meilleur", "Élégant", "Ancien"], ["casque sans fil", "sac à dos", "aspirateur", "appareil photo", "haut-parleur", "tournevis", "parapluie"]),
    "es": (["Nuevo", "Pequeño", "Gran", "Ligero", "Mejor", "Hermoso", "Antiguo"], ["auricular inalámbrico", "mochila", "aspiradora", "cámara fotográfica", "altavoz", "destornillador", "paraguas"]),
    "pt": (["Novo", "Pequena", "Melhor", "Leve", "Bonito", "Velho", "Rápido"], ["fone sem fio", "mochila escolar", "aspirador de pó", "câmera", "alto-falante", "chave de fenda", "guarda-chuva"]),
    "hi": (["नया", "छोटा", "बड़ा", "हल्का", "सुंदर", "पुराना", "तेज़"], ["हेडफ़ोन", "बैग", "कैमरा", "छाता", "पंखा", "घड़ी", "जूते"]),
    "ja": (["新しい", "小さな", "大きな", "軽い", "美しい", "古い", "速い"], ["ヘッドホン", "リュックサック", "カメラ", "傘", "扇風機", "時計", "靴"]),
    "zh": (["新款", "小型", "大号", "轻便", "美丽", "古老", "快速"], ["耳机", "背包", "照相机", "雨伞", "电风扇", "手表", "鞋子"]),
}
COLUMNS = {f"name_{lang}": lang for lang in PARTS}


@pytest.fixture(scope="module")
def catalogue(spark):
    """980 products; every twentieth has the names of two languages exchanged."""
    langs, rows, swapped = list(PARTS), [], set()
    made = {lang: [f"{a} {b}" for a, b in itertools.product(*PARTS[lang])] for lang in langs}
    for i in range(980):
        names = {lang: f"{made[lang][i * 11 % 49]}{' ' + str(i % 5) if i % 3 else ''}" for lang in langs}
        if i % 20 == 7:
            a, b = langs[i % 7], langs[(i + 1 + i // 140) % 7]
            if a != b:
                names[a], names[b] = names[b], names[a]
                swapped |= {(i, a), (i, b)}
        rows.append((i, *[None if i % 20 == 3 else names[lang] for lang in langs]))
    return spark.createDataFrame(rows, "id int, " + ", ".join(f"{c} string" for c in COLUMNS)), swapped


def test_swapped_names_are_found(catalogue):
    df, swapped = catalogue
    flagged = trigrams.flag_wrong_names(df, COLUMNS)
    assert flagged.columns == [*df.columns, *[f"{c}_flag" for c in COLUMNS]]
    found = {(r.id, lang) for r in flagged.collect() for c, lang in COLUMNS.items() if r[f"{c}_flag"] == "WRONG_LANGUAGE"}
    assert len(swapped) >= 60
    assert len(found & swapped) >= 0.9 * len(swapped)
    assert len(found - swapped) <= 0.01 * df.count() * len(COLUMNS)


def test_large_models_are_joined(catalogue, monkeypatch):
    from burnish.operators import skew

    two = {c: COLUMNS[c] for c in ("name_de", "name_fr")}
    df = catalogue[0].select("id", *two)
    plain = sorted(map(str, trigrams.flag_wrong_names(df, two).collect()))
    monkeypatch.setattr(skew, "BROADCAST_ROWS", 0)
    assert sorted(map(str, trigrams.flag_wrong_names(df, two).collect())) == plain


def test_awkward_names(spark):
    rows = [(1, None, "x"), (2, "", "en"), (3, "123 !?", "en"), (4, "a", "en"), (5, "the name", None), (6, "the name", "en"), (7, "The  NAME", "en"), (8, "w" * 20_000, "de"), (9, "𠮷野家 x", "ja")]
    values = trigrams.distinct_values(spark.createDataFrame(rows, "id int, t string, lang string"), "t", "lang")
    got = {r.value: (r.guess, r.wrong) for r in trigrams.judge(values, *trigrams.learn(values)).collect()}
    assert got[""] == got["123 !?"] == (None, False) and got["the name"][0] == "en" and not got["The  NAME"][1]
    (kana,) = values.filter("label = 'ja'").select(trigrams.trigrams(F.col("value")).alias("g")).collect()
    assert kana.g == [" 𠮷野", "𠮷野家", "野家 ", "家 x", " x "]
    nothing = values.filter("false")
    assert trigrams.judge(nothing, *trigrams.learn(nothing)).count() == 0
    unknown = values.select(F.lit("xx").alias("label"), "value", "n")
    assert not trigrams.judge(unknown, *trigrams.learn(values)).filter("wrong OR guess IS NOT NULL").count()


def _wide(spark, n, k):
    cols = [F.when((F.col("id") * 7 + i) % 11 == 0, None).otherwise(F.sin(F.col("id") * (i + 1)) * (i + 1) + F.col("id") * (i % 5) + 1e6 * (i % 2)).alias(f"c.{i}") for i in range(k)]
    return spark.range(0, n, 1, 7).select(*cols, F.lit(3.0).alias("flat"), F.lit(None).cast("double").alias("none"))


def test_matrix_equals_corr(spark):
    df = _wide(spark, 5_000, 12)
    cols = df.columns
    got = {(r.column_a, r.column_b): r.r for r in gram.correlation_matrix(df, cols).collect()}
    assert list(got) and len(got) == len(cols) * (len(cols) - 1) // 2
    plain = df.toDF(*[c.replace(".", "_") for c in cols])
    pairs = [(a.replace(".", "_"), b.replace(".", "_")) for a, b in got]
    want = {(r.column_a, r.column_b): r.r for r in correlations(plain, pairs).collect()}
    for (a, b), r in got.items():
        if "flat" in (a, b):
            assert r is None  # of a constant column, where rounding makes up an r from single passes
            continue
        other = want[a.replace(".", "_"), b.replace(".", "_")]
        assert (r is None and other is None) or r == pytest.approx(other, abs=1e-9), (a, b)


def test_many_columns_take_one_scan(spark, tmp_path):
    path = str(tmp_path / "wide")
    _wide(spark, 2_000, 200).write.parquet(path)
    df = spark.read.parquet(path)
    numbers = df.select(*[F.col(f"`{c}`") for c in df.columns])
    seen = []
    original = gram.materialise
    gram.materialise = lambda frame, name: seen.append(frame) or original(frame, name)
    try:
        done = gram.correlation_matrix(numbers, df.columns)
        assert done.count() == 202 * 201 // 2
    finally:
        gram.materialise = original
    assert len(seen) == 1 and seen[0]._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1
    assert path not in done._jdf.queryExecution().executedPlan().toString()
    found = {(r.column_a, r.column_b) for r in correlated_pairs(df, ["c.1", "c.2", "c.3", "c.4", "flat"], 0.7).collect()}
    assert ("c.2", "c.3") in found and not any("flat" in p for p in found)


def test_matrix_of_empty_tables_and_missing_numbers(spark):
    empty = spark.createDataFrame([], "a double, b double")
    assert [tuple(r) for r in gram.correlation_matrix(empty, ["a", "b"]).collect()] == [("a", "b", 0, None)]
    df = spark.createDataFrame([(1.0, float("nan")), (2.0, 4.0), (3.0, 6.0), (None, 9.0)], "a double, b double")
    (row,) = gram.correlation_matrix(df, ["a", "b"]).collect()
    assert row.rows == 2 and row.r == pytest.approx(1.0)


CODES = {
    "00501": "string", "0": "bigint", "-0": "bigint", "-12": "bigint", "+12": "string", "1E5": "string", "1.0E5": "double", "0.5": "double", "00.5": "string", ".5": "double",
    "-.5": "double", "5.": "double", "12D": "string", "1f": "string", "-007": "string", "1e+5": "string", " 12": "bigint", "123456789012345678901": "decimal(38,0)",
}


def test_codes_stay_text(spark):
    for text, kind in CODES.items():
        df = spark.createDataFrame([(text,), (None,)], "v string")
        assert Y.inferred_schema(Y.infer_types(df))["v"] == kind, text
    mixed = spark.createDataFrame([("1E5",), ("2.5",)], "v string")
    assert Y.inferred_schema(Y.infer_types(mixed))["v"] == "double"
