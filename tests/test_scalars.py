"""Column functions on hand-made values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import scalars as X


def one(spark, expr, **values):
    ddl = ", ".join(f"{k} {v[1]}" for k, v in values.items())
    df = spark.createDataFrame([tuple(v[0] for v in values.values())], ddl) if values else spark.range(1)
    return df.select(expr.alias("v")).first()["v"]


@pytest.mark.parametrize("raw, text, key", [("  brk.b \n", "BRK.B", "BRK-B"), ("", None, None), ("  ", None, None), (None, None, None), ("a", "A", "A")])
def test_symbols(spark, raw, text, key):
    assert one(spark, X.symbol("x"), x=(raw, "string")) == text
    assert one(spark, X.join_key("x"), x=(raw, "string")) == key


@pytest.mark.parametrize("raw, want", [("CIK 320193", "0000320193"), ("12345678901", "12345678901"), ("none", None), (None, None), ("0000000001", "0000000001")])
def test_cik(spark, raw, want):
    assert one(spark, X.cik("x"), x=(raw, "string")) == want


@pytest.mark.parametrize("raw, want", [("True", True), (" yes ", True), ("0", False), ("NO", False), (None, None), ("maybe", True), ("", False)])
def test_nullable_bool(spark, raw, want):
    assert one(spark, X.nullable_bool("x"), x=(raw, "string")) is want


@pytest.mark.parametrize("raw, want", [("2020-08-31", dt.date(2020, 8, 31)), ("2020-08-31T23:30:00-05:00", dt.date(2020, 9, 1)), ("2020-08-31T05:00:00Z", dt.date(2020, 8, 31)), ("never", None), (None, None)])
def test_dates(spark, raw, want):
    assert one(spark, X.utc_date("x"), x=(raw, "string")) == want


def test_numbers(spark):
    assert [one(spark, X.integer("x"), x=(v, "string")) for v in ("12", "12.7", "x", None)] == [12, None, None, None]
    assert one(spark, X.integer("x"), x=(12.7, "double")) == 12
    assert [one(spark, X.number("x"), x=(v, "string")) for v in ("1.5", "", "nan", None)] == [1.5, None, None, None]


def test_structure_reason(spark):
    names = {"Alpha Business Development Company": "business_development_company", "Alpha BDC": "business_development_company", "Beta L.P.": "limited_partnership", "Gamma Limited Partnership": "limited_partnership", "Help Inc": None, "LPL Financial": None}
    assert {n: one(spark, X.structure_reason("x"), x=(n, "string")) for n in names} == names


def test_identity_order(spark):
    row = {"symbol": ("ABC", "string"), "name": ("Abc Inc", "string"), "exchange": (None, "string"), "share": (None, "string"), "comp": (None, "string"), "cik": (None, "string")}
    value = lambda **more: tuple(one(spark, e, **(row | more)) for e in X.security_identity("symbol", "name", "exchange", "share", "comp", "cik"))
    assert value(share=("S1", "string"), comp=("C1", "string")) == ("share_class_figi:S1", "share_class_figi")
    assert value(comp=("C1", "string"), cik=("1", "string")) == ("composite_figi:C1", "composite_figi")
    assert value(cik=("0000000001", "string")) == ("cik_symbol:0000000001:ABC", "cik_symbol")
    import hashlib

    digest = hashlib.sha256(b"|ABC|Abc Inc").hexdigest()[:20]
    assert value() == (f"massive_fallback:{digest}", "massive_fallback")


@pytest.mark.parametrize("day, want", [("2026-09-21", "2026-09-18"), ("2026-09-20", "2026-09-18"), ("2026-09-19", "2026-09-18"), ("2026-09-22", "2026-09-21")])
def test_latest_session(spark, day, want):
    assert str(one(spark, X.latest_session(F.lit(day).cast("date")))) == want


def test_intervals(spark):
    d = lambda s: (None if s is None else dt.date.fromisoformat(s), "date")
    overlap = lambda a, b, c, e: one(spark, X.overlaps("a", "b", "c", "e"), a=d(a), b=d(b), c=d(c), e=d(e))
    assert overlap("2020-01-01", "2020-02-01", "2020-02-01", None) is True
    assert overlap("2020-01-01", "2020-01-31", "2020-02-01", None) is False
    assert overlap(None, "2000-01-01", "2020-02-01", None) is True
    inside = lambda day, a, b, floor=None: one(spark, X.within("day", "a", "b", floor), day=d(day), a=d(a), b=d(b))
    assert inside("2015-01-01", None, None) is True
    assert inside("2015-01-01", None, None, dt.date(2016, 1, 1)) is False
    assert inside("2020-01-01", "2020-01-01", "2020-01-01") is True


def test_payloads(spark):
    a, b = '{"b": 1, "a": {"d": "x", "c": [1, 2]}}', '{"a":{"c":[1,2],"d":"x"},"b":1}'
    assert one(spark, X.canonical_json("x"), x=(a, "string")) == b == one(spark, X.canonical_json("x"), x=(b, "string"))
    assert one(spark, X.canonical_json("x"), x=("no json", "string")) is None
    assert one(spark, X.redacted("x"), x=({"Api-Key": "k", "limit": "5", "access_TOKEN": "t"}, "map<string,string>")) == {"Api-Key": "[REDACTED]", "limit": "5", "access_TOKEN": "[REDACTED]"}
    assert one(spark, X.safe_url("x"), x=("https://a.b/c?key=1#f", "string")) == "https://a.b/c"
    assert one(spark, X.scrubbed("x", "s3cret", ""), x=("error for s3cret", "string")) == "error for [REDACTED]"
    assert one(spark, X.without("x", "b"), x=("a;b;c", "string")) == "a;c" and one(spark, X.without("x", "b"), x=("b", "string")) is None
    assert one(spark, X.first_true(F.col("x"), F.col("y")), x=("0", "string"), y=("2", "string")) == "2"
