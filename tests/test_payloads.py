"""Canonical payloads against Python's own printing."""

import json
import random

from pyspark.sql import functions as F

from ledgerloom.functions import payloads
from ledgerloom.functions import scalars as X
from ledgerloom.sources import pages as P

ODD = [
    '{"b": 1.0, "a": 1e3}', '{"n": [1.50, -0.0, 0, -0, 12345678901234567890123, {"z": 1E22, "y": 1e-7}]}', '{"a": 1, "a": 2}', '{"a": 0.1}', '{"a":123456789012345678}',
    '{"x": "1.0", "y": "a\\"b\\u00e9\\u0001\\/"}', '{"é": "ü", "z": "😀", "\\ud83d\\ude00": 1, "\\uffff": 2}', '{"a": {"c": [1, 2, []], "b": {}}, "A": null, "_": true}', "[]", "3", "3.0", '"x"',
    "no json", "", '{"a": 1', "{'a': 1}", '{"a": 5e-324, "b": 1.7976931348623157e308, "c": 2.2250738585072014e-308, "d": 9007199254740993.0}', '{"a":"tab\tin"}', None,
]


def by_hand(text):
    try:
        return None if text is None else json.dumps(json.loads(text), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except ValueError:
        return None


def value(r, depth=0):
    kind = r.randrange(9 if depth < 3 else 6)
    if kind == 0:
        return r.choice(["1.0", "2.50", "1e3", "-0.0", "100", "0", "-7", "1E-5", "123456789012345678901"])
    if kind < 6:
        return r.choice(['"x"', '"1.0"', '"é ü"', "true", "null", "12", '"2024-01-05"', '""'])
    if kind < 8:
        keys = r.sample(["b", "a", "A", "ä", "rate", "a b", "z9"], r.randrange(4))
        return "{" + ", ".join(f'"{k}": {value(r, depth + 1)}' for k in keys) + "}"
    return "[" + " , ".join(value(r, depth + 1) for _ in range(r.randrange(4))) + "]"


def test_canonical_payloads_are_pythons(spark):
    r = random.Random(1)
    texts = ODD + [value(r) for _ in range(400)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = dict(df.select("i", X.canonical_json("t")).collect())
    for i, t in enumerate(texts):
        assert got[i] == by_hand(t), t


def test_plain_payloads_stay_in_built_in_functions(spark):
    """The batch function is handed only what the built-in ones would print otherwise."""
    plain, other = '{"b": [1, "2.5", null], "a": {"x": true}}', '{"b": [1, 2.5]}'
    df = spark.createDataFrame([(plain,), (other,)], "t string")
    bare = F.regexp_replace("t", r'"[^"\\]*"', '""')
    assert [x[0] for x in df.select(~bare.rlike(payloads._OTHER_NUMBERS)).collect()] == [True, False]


def test_action_rows_keep_fractions(spark):
    body = '{"corporate_actions": {"forward_splits": [{"id": "1", "new_rate": 2.0, "old_rate": 1}, {"id":"2","new_rate":1e1,"nested":{"b":[1.50],"a":3}}], "cash_dividends": []}}'
    rows = P.action_rows(spark.createDataFrame([(1, body)], "page_no int, body string"))
    got = {x["pos"]: x["c"] for x in rows.withColumn("c", X.canonical_json("raw")).collect()}
    entries = json.loads(body)["corporate_actions"]["forward_splits"]
    assert got == {i: json.dumps(e, sort_keys=True, separators=(",", ":"), ensure_ascii=False) for i, e in enumerate(entries)}


def test_what_python_has_spelled_is_not_tried_again(spark):
    texts = [' {"b":1.50,"a":1}', '{"b":1.50,"a":1} ', '{"b":1.5}{}', '{"a":2,"a":1}', "1.0", "", None, '{"z":1,"a":"x"}', "[1", "[1.0"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", payloads.canonical_json(F.col("t")).alias("c"))
    want = ['{"a":1,"b":1.5}', '{"a":1,"b":1.5}', None, '{"a":1}', "1.0", None, None, '{"a":"x","z":1}', None, None]
    assert [r["c"] for r in df.collect()] == want
    assert [payloads.canonical_text(t) for t in texts] == want
    assert "coalesce(pythonUDF" in df._jdf.queryExecution().optimizedPlan().toString()
