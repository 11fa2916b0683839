"""Published raw -> cleaned cell pairs, one rule at a time."""

import pytest
from pyspark.sql import functions as F

from burnish.functions import numbers as N
from burnish.functions import text as X
from burnish.plans import domains as P


def one(spark, value, fn, kind="string"):
    df = spark.createDataFrame([(value,)], f"v {kind}")
    return df.select(fn(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize(
    "value, expected",
    [
        ("userATdomain.com123", None),
        ("user@domaincom2", None),
        ("user@.com3", None),
        ("a@b@c.d", None),
        ("@domain.com5", None),
        ("user@domain.4", "user@domain.4"),
        ("John@Mail.Example.com", "john@mail.example.com"),
        (None, None),
    ],
)
def test_email(spark, value, expected):
    assert one(spark, value, X.clean_email) == expected


@pytest.mark.parametrize(
    "value, expected",
    [("Version 2.1", "v2.1"), ("2.1.0", "v2.1.0"), ("2_1", "v2.1"), ("v2.1", "v2.1"), ("3_0", "v3.0"), (None, None)],
)
def test_version(spark, value, expected):
    assert one(spark, value, X.clean_version) == expected


def test_version_semver(spark):
    assert one(spark, "2_1", lambda c: X.clean_version(c, semver=True)) == "v2.1.0"
    assert one(spark, "v3", lambda c: X.clean_version(c, semver=True)) == "v3.0.0"


@pytest.mark.parametrize(
    "value, expected",
    [("GL-1000", "1000"), ("1000-00", "1000"), ("01000", "1000"), ("1000", "1000"), ("7", "0007"), ("0100", "0100"),
     (" gl-2000 ", "2000"), ("12345", "1234"), (None, None)],
)
def test_account_code(spark, value, expected):
    assert one(spark, value, X.clean_account_code) == expected


@pytest.mark.parametrize(
    "value, mapping, expected",
    [
        ("actv", P.STATUS, "ACTIVE"),
        ("apprvd", P.APPROVAL, "APPROVED"),
        ("pump", P.DEVICE_TYPE, "PUMP"),
        ("Elec.", P.CATEGORY, "ELECTRONICS"),
        ("R&D", P.DEPARTMENT, "ENGINEERING"),
        ("Customer Success", P.DEPARTMENT, "CUSTOMER_SUCCESS"),
        ("something", P.DEPARTMENT, "SOMETHING"),
        (None, P.DEPARTMENT, None),
    ],
)
def test_map(spark, value, mapping, expected):
    assert one(spark, value, lambda c: X.map_values(c, mapping)) == expected


@pytest.mark.parametrize("value, expected", [("Software as a Service", "SAAS"), (" FinTech ", "FINTECH"), (None, None)])
def test_industry(spark, value, expected):
    assert one(spark, value, lambda c: X.standardise_rule(c, P.INDUSTRY)) == expected


def test_text(spark):
    assert one(spark, "  John Smith  ", X.trim_ws) == "John Smith"
    assert one(spark, "\t John\n", X.trim_ws) == "John"
    html = "<p><b>Great!</b> Product 441.</p>"
    assert one(spark, html, X.strip_html) == "Great! Product 441."
    assert one(spark, " no tags ", X.strip_html) == " no tags "
    assert one(spark, "ORD-0000047", X.id_suffix) == 47
    assert one(spark, "nothing", X.id_suffix) is None
    assert one(spark, "caf\u0099", X.bad_encoding) is True
    assert one(spark, "caf�", X.bad_encoding) is True
    assert one(spark, "café", X.bad_encoding) is False


@pytest.mark.parametrize(
    "value, expected",
    [("(212) 555-0100", "+12125550100"), ("+49 30 1234567", "+49301234567"), ("0044 20 7946 0000", "+442079460000"),
     ("ext 12", "ext 12"), ("12", "12"), (None, None)],
)
def test_phone(spark, value, expected):
    assert one(spark, value, X.clean_phone) == expected


def test_numbers(spark):
    assert one(spark, 145.0, lambda c: N.clip(c, -50, 100), "double") == 100.0
    assert one(spark, None, lambda c: N.clip(c, -50, 100), "double") is None
    assert one(spark, 189.9999998, N.round2, "double") == 190.0
    assert one(spark, -4521.33, N.abs_value, "double") == 4521.33
    assert one(spark, "12,5", N.to_number) is None
    assert one(spark, 5.0, lambda c: N.clean_ratio(c, F.lit(0.0)), "double") is None


def test_mixed_timestamps(spark):
    df = spark.createDataFrame([("2024-01-02",), ("01/02/2024",), ("junk",), (None,)], "v string")
    out = [r[0] for r in df.select(N.to_ts(F.col("v"), ["yyyy-MM-dd", "MM/dd/yyyy"])).collect()]
    assert [None if x is None else x.isoformat() for x in out] == ["2024-01-02T00:00:00", "2024-01-02T00:00:00", None, None]


def test_days_are_whole_elapsed_days(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 18:00:00' a, TIMESTAMP_NTZ'2024-01-03 06:00:00' b")
    assert df.select(N.days_between(F.col("a"), F.col("b"))).first()[0] == 1
