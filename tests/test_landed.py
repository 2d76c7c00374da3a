"""Landed files: what a task reads, parses and sorts stays small, whatever the length of a file."""

import datetime as dt
import gzip
import hashlib
import json

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import actions as A
from ledgerloom.plans import landed_queries as L
from ledgerloom.sources import pages as P


def test_lines_of_one_packed_file_are_dealt_to_many_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(P, "TASK_BYTES", 1 << 10, raising=False)
    for day, first in (("2001-01-01", 0), ("2001-01-02", 1000)):
        with gzip.open(tmp_path / f"{day}.jsonl.gz", "wt") as f:
            f.write("".join(json.dumps({"n": n}) + "\n\n" for n in range(first, first + 1000)))
    pages = P.landed_pages(spark, f"{tmp_path}/*")
    assert pages.rdd.getNumPartitions() >= 8 and max(pages.rdd.glom().map(len).collect()) < 500
    assert [json.loads(r["body"])["n"] for r in pages.orderBy("page_no").collect()] == list(range(2000))


def test_bars_to_land_are_computed_once(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)
    bars = [(f"P{k}", dt.date(2001, 1, 1 + n), k + n / 4) for k in range(1, 36) for n in range(3)]

    def counted(bar):
        read.add(1)
        return bar

    rows = spark.createDataFrame(spark.sparkContext.parallelize(bars, 2).map(counted), "symbol string, date date, raw_close double")
    monkeypatch.setattr(L, "view", lambda *_: rows)
    got = sorted(tuple(r) for r in L.landed_bars(spark, "").collect())
    assert got == sorted((s, d, c + (2 if int(s[1:]) % 7 == 0 else 1)) for s, d, c in bars)
    assert read.value == len(bars)


def test_actions_move_whole_once_and_undated_repeats_fail(spark, tmp_path, monkeypatch):
    written, tables = A.written, {}

    def kept(df, name):
        tables[name] = written(df, name)
        return tables[name]

    monkeypatch.setattr(A, "written", kept)
    raw = lambda i, day, symbol: json.dumps({"id": i, "process_date": day, "symbol": symbol, "new_symbol": "BBB"})
    landed = [(1, 0, raw("1", "2020-01-01", "AAA")), (2, 0, raw("1", "2020-01-02", "BBB")), (2, 1, raw("2", "2020-01-02", None)), (3, 0, raw("1", "2020-01-02", "AAA"))]
    rows = spark.createDataFrame([(p, n, "spin_off", r.replace("symbol", "source_symbol", 1)) for p, n, r in landed], "page_no long, pos int, action_type string, raw string")
    episodes = spark.createDataFrame([("s1", "AAA", None, None, True), ("s2", "BBB", None, None, True)], "security_id string, symbol string, symbol_valid_from date, symbol_valid_to date, is_episode_mapping_eligible boolean")
    out = A.corporate_actions(rows, episodes, dt.date(2021, 1, 1))
    got = {r["provider_event_id"]: (r["primary_symbol"], r["security_id"], r["identity_match_status"], r["related_security_id"]) for r in out.collect()}
    assert got == {"1": ("AAA", "s1", "matched", "s2"), "2": (None, None, "not_applicable", "s2")}
    assert all(r["raw_payload_sha256"] == hashlib.sha256(r["raw_payload_json"].encode()).hexdigest() for r in out.collect())
    # what is written holds one row an event and no hash; look-ups write ids and what they found
    assert {n: t.count() for n, t in tables.items()} == {"actions-kept": 2, "action-identities": 2}
    assert not any("raw_payload_sha256" in t.columns for t in tables.values()) and "raw_payload_json" not in tables["action-identities"].columns
    undated = rows.unionByName(rows.limit(1).withColumn("raw", F.lit('{"id": "2"}')))
    with pytest.raises(ValueError, match="action 2 is missing process_date"):
        A.corporate_actions(undated, episodes, dt.date(2021, 1, 1))
