"""The operators on small worked cases."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas as S
from ledgerloom.operators import actions as A
from ledgerloom.operators import audit as U
from ledgerloom.operators import bars as B
from ledgerloom.operators import episodes as E
from ledgerloom.operators import identity as I
from ledgerloom.operators import metrics as M
from ledgerloom.operators import validate as V
from ledgerloom.sources import html_tables as H
from ledgerloom.sources import pages as P

D = dt.date.fromisoformat
SNAP = dt.date(2026, 9, 11)
LISTING = ", ".join(c for c in S.LISTING_ROW.split(", "))


def listings(spark, *rows):
    names = [c.split()[0] for c in S.LISTING_ROW.split(", ")]
    base = {"type": "CS", "market": "stocks", "locale": "us", "currency_name": "usd", "primary_exchange": "XNAS", "active": "true", "last_updated_utc": "2026-09-01T00:00:00Z"}
    return spark.createDataFrame([tuple((base | r).get(n) for n in names) + (0, i) for i, r in enumerate(rows)], S.LISTING_ROW + ", page_no long, pos int")


def assets(spark, *rows):
    names = [c.split()[0] for c in S.ASSET_ROW.split(", ")]
    return P.normalised_assets(spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], S.ASSET_ROW))


def test_master_identity_and_asset_spelling(spark):
    rows = [{"ticker": "BRK.B", "name": "Berkshire", "share_class_figi": "F1"}, {"ticker": "OLD", "name": "Gone Inc", "active": "false", "delisted_utc": "2020-05-01", "composite_figi": "C9"}, {"ticker": " ", "name": "blank"}]
    got = {r["symbol"]: r for r in I.security_master(listings(spark, *rows), assets(spark, {"id": "a1", "symbol": "brk-b", "exchange": "nyse", "status": "Active", "tradable": "true"}), SNAP).collect()}
    assert set(got) == {"BRK.B", "OLD"} and list(got["OLD"].asDict()) == S.SECURITY_MASTER.names
    b = got["BRK.B"]
    assert (b["security_id"], b["alpaca_asset_id"], b["alpaca_asset_match_status"], b["coverage_reason"]) == ("share_class_figi:F1", "a1", "normalized_symbol", "provider_symbol_spelling_differs")
    o = got["OLD"]
    assert o["is_price_coverage_eligible"] and not o["has_alpaca_asset"] and o["coverage_reason"] == "no_current_alpaca_asset" and o["delisted_date"] == D("2020-05-01")


def test_master_keeps_the_newest_row(spark):
    same = {"ticker": "AAA", "name": "A", "share_class_figi": "F"}
    rows = [same | {"name": "old", "last_updated_utc": None}, same | {"name": "new"}, same | {"name": "tie, landed last"}, same | {"name": "inactive", "active": "false"}]
    got = I.security_master(listings(spark, *rows), assets(spark), SNAP).collect()
    assert [r["company_name"] for r in got] == ["tie, landed last"]


def test_master_exclusions(spark, rows):
    data = [
        {"ticker": "ADR", "name": "x", "type": "ADRC", "share_class_figi": "1"}, {"ticker": "UK", "name": "x", "locale": "gb", "share_class_figi": "2"}, {"ticker": "CAD", "name": "x", "currency_name": "cad", "share_class_figi": "3"},
        {"ticker": "OTC", "name": "x", "primary_exchange": None, "share_class_figi": "4"}, {"ticker": "RE.T", "name": "x", "share_class_figi": "5"}, {"ticker": "SP", "name": "x", "share_class_figi": "6"},
        {"ticker": "LP", "name": "Pipes L.P.", "share_class_figi": "7"}, {"ticker": "DEAD", "name": "x", "active": "false", "delisted_utc": "2015-12-31", "share_class_figi": "8"},
        {"ticker": "TWO", "name": "x", "share_class_figi": "9"}, {"ticker": "TWO", "name": "y", "share_class_figi": "10"}, {"ticker": "OK", "name": "x", "currency_name": None, "share_class_figi": "11"}, {"ticker": "PL", "name": "x", "share_class_figi": "12"},
    ]
    reits = spark.createDataFrame([("re-t",)], "symbol string")
    sectors = spark.createDataFrame([("SP", "SP", "Real Estate", "Retail REIT"), ("PL", "PL", "Real Estate", "Industrial REITs")], "symbol string, symbol_join_key string, sector string, industry string")
    master = I.security_master(listings(spark, *data), assets(spark), SNAP, reits, sectors).cache()
    why = {r["symbol"]: r["exclusion_reason"] for r in master.collect()}
    assert why == {"ADR": "not_common_stock", "UK": "not_us_stock", "CAD": "non_usd_currency", "OTC": "ineligible_exchange", "RE.T": "known_reit_or_reoc", "SP": "known_reit_or_reoc", "LP": "limited_partnership", "DEAD": "delisted_before_history_window", "TWO": "ambiguous_reused_symbol", "OK": None, "PL": None}
    assert rows(I.pending_tickers(master), "symbol", "episode_status", "is_episode_mapping_eligible") == [("OK", "pending_episode_enrichment", False), ("PL", "pending_episode_enrichment", False)]
    assert dict(rows(M.reason_counts(I.exclusions(master), "exclusion_reason")))["ambiguous_reused_symbol"] == 2
    assert I.pending_tickers(master).columns == S.TICKERS.names
    assert master.count() == I.exclusions(master).count() + 2


MASTER = "security_id string, symbol string, company_name string, active boolean, delisted_date date, is_price_coverage_eligible boolean, exclusion_reason string, symbol_identity_conflict boolean, share_class_figi string, composite_figi string, cik string, primary_exchange string, sector string, industry string, alpaca_asset_id string, alpaca_status string, alpaca_tradable boolean, is_known_reit boolean, last_updated_utc timestamp, has_alpaca_asset boolean"


def master(spark, *rows):
    return spark.createDataFrame([(s, sym, f"{s} name", active, D(gone) if gone else None, fine, None, False, f"f{s}", f"c{sym}", "1", "XNYS", None, "Tools", f"a{sym}", "active", True, None, dt.datetime(2026, 1, 1), True) for s, sym, active, gone, fine in rows], MASTER)


def changes(spark, *rows):
    return spark.createDataFrame([(i, D(day), old, new) for i, day, old, new in rows], "event_id string, process_date date, old_symbol string, new_symbol string")


def spans(df):
    return sorted((r["security_id"], r["symbol"], str(r["symbol_valid_from"]), str(r["symbol_valid_to"]), r["episode_status"]) for r in df.collect())


def test_rename_chain_with_missing_middle(spark, rows):
    m = master(spark, ("s1", "SYMC", False, "2019-11-05", True), ("s1", "GEN", True, None, True))
    e = E.symbol_episodes(m, changes(spark, ("e1", "2019-11-05", "SYMC", "NLOK"), ("e2", "2022-11-08", "NLOK", "GEN")), SNAP).cache()
    assert spans(e) == [("s1", "GEN", "2022-11-08", "None", "current"), ("s1", "NLOK", "2019-11-05", "2022-11-07", "bounded"), ("s1", "SYMC", "2016-01-01", "2019-11-04", "bounded")]
    assert {r["symbol"]: r["episode_source"] for r in e.collect()} == {"GEN": "alpaca_name_change;massive_inventory", "NLOK": "alpaca_name_change", "SYMC": "alpaca_name_change;history_window_floor;massive_inventory"}
    assert e.columns == S.EPISODES.names
    assert rows(E.episode_tickers(e, m), "symbol", "alpaca_asset_id", "industry") == [("GEN", "aGEN", "Tools"), ("NLOK", None, "Tools"), ("SYMC", "aSYMC", "Tools")]


def test_reused_symbol_ignores_later_change(spark):
    m = master(spark, ("s1", "META", False, "2018-01-01", True))
    e = E.symbol_episodes(m, changes(spark, ("e1", "2022-06-09", "FB", "META")), dt.date(2018, 2, 1))
    assert spans(e) == [("s1", "META", "2016-01-01", "2017-12-31", "bounded")]


def test_known_symbol_is_preferred(spark):
    m = master(spark, ("s1", "NEW", True, None, True), ("s1", "MINE", False, "2019-01-01", True))
    e = E.symbol_episodes(m, changes(spark, ("e1", "2019-01-01", "MINE", "NEW"), ("e2", "2021-01-01", "OTHER", "NEW")), SNAP)
    assert [x[1] for x in spans(e)] == ["MINE", "NEW"]


def test_overlap_of_two_securities(spark):
    m = master(spark, ("s1", "DUP", True, None, True), ("s2", "DUP", False, "2020-01-01", True), ("s3", "OWN", True, None, True))
    e = E.symbol_episodes(m, changes(spark), SNAP)
    assert {(r["security_id"], r["episode_status"], r["is_episode_mapping_eligible"], r["is_price_coverage_eligible"]) for r in e.collect()} == {("s1", "unresolved", False, True), ("s2", "unresolved", False, True), ("s3", "current", True, True)}


def test_cycle_of_renames_ends(spark):
    m = master(spark, ("s1", "A", True, None, True))
    e = E.chains(m, changes(spark, ("e1", "2020-01-01", "B", "A"), ("e2", "2019-01-01", "A", "B"), ("e3", "2018-01-01", "B", "A")), SNAP)
    assert sorted((r["step"], r["cursor"], r["old"]) for r in e.collect()) == [(1, "A", "B"), (2, "B", "A")]


def test_chains_and_fill_against_a_loop(spark):
    """Random renames: the recursive query gives what walking each security does."""
    r = random.Random(3)
    symbols = [f"S{k}" for k in range(9)]
    events = [(f"e{k:03}", str(dt.date(2018, 1, 1) + dt.timedelta(days=r.randrange(1500))), *r.sample(symbols, 2)) for k in range(60)]
    held = [(f"sec{k}", s, k % 2 == 0 and i == 0, None if k % 2 == 0 and i == 0 else str(dt.date(2021, 1, 1) + dt.timedelta(days=r.randrange(300))), True) for k in range(25) for i, s in enumerate(r.sample(symbols, r.choice([1, 2, 3])))]
    got = {}
    for x in E.symbol_episodes(master(spark, *held), changes(spark, *events), SNAP).collect():
        got[(x["security_id"], x["symbol"])] = (x["symbol_valid_from"], x["symbol_valid_to"])
    want = {}
    one = dt.timedelta(days=1)
    for sec, group in itertools.groupby(held, key=lambda x: x[0]):
        own = {s: (active, D(gone) if gone else None) for _, s, active, gone, _ in group}
        active = [s for s, (a, _) in own.items() if a]
        end = active[0] if len(active) == 1 else max(own, key=lambda s: (own[s][0], own[s][1] or dt.date.max, s))
        current = end if len(active) == 1 else None
        since, until, seen, at, before = {}, {}, {end}, end, SNAP + one
        while True:
            may = sorted(((-D(d).toordinal(), e, old, D(d)) for e, d, old, new in events if new == at and D(d) < before))
            if not may:
                break
            mine = [x for x in may if x[2] in own]
            _, _, old, day = mine[0] if len(mine) == 1 else may[0]
            since[at], until[old] = day, day - one
            if old in seen:
                break
            seen.add(old)
            at, before = old, day
        for s, (_, gone) in own.items():
            if s != current and s not in until and gone:
                until[s] = gone - one
        order = sorted(set(own) | set(since) | set(until), key=lambda s: (until.get(s, dt.date.max), since.get(s, dt.date.max), s))
        s0, u0 = dict(since), dict(until)
        for k, s in enumerate(order):
            a = s0.get(s) or (S.HISTORY_START if k == 0 else (u0[order[k - 1]] + one if order[k - 1] in u0 else None))
            b = u0.get(s) or (s0[order[k + 1]] - one if k + 1 < len(order) and order[k + 1] in s0 else None)
            want[(sec, s)] = (a, b)
    assert got == want


def test_name_changes_validity(spark, rows):
    body = json.dumps({"corporate_actions": {"name_changes": [{"id": "1", "old_symbol": "fb", "new_symbol": "META", "process_date": "2022-06-09"}, {"id": "2", "old_symbol": "30303M102", "new_symbol": "X", "process_date": "2022-06-09"}, {"id": "3", "old_symbol": "A", "new_symbol": "A", "process_date": "2022-06-09"}, {"id": "4", "old_symbol": "A", "new_symbol": "B"}, 7]}})
    pages = spark.createDataFrame([(0, body), (1, "{}")], "page_no long, body string")
    assert rows(P.name_change_rows(pages), "event_id", "old_symbol", "new_symbol") == [("1", "FB", "META")]


EPISODES = "episode_id string, security_id string, symbol string, provider_symbol string, current_symbol string, symbol_valid_from date, symbol_valid_to date, is_episode_mapping_eligible boolean"


def episodes(spark, *rows):
    return spark.createDataFrame([(f"{s}|{sym}", s, sym, sym, sym, D(a) if a else None, D(b) if b else None, fine) for s, sym, a, b, fine in rows], EPISODES)


def test_action_identity(spark):
    e = episodes(spark, ("s1", "AAA", "2016-01-01", "2020-01-01", True), ("s2", "BBB", "2020-01-02", None, True), ("s3", "DUP", None, None, True), ("s4", "DUP", None, None, True), ("s5", "BAD", None, None, False), ("s6", "AAA", "2020-01-02", None, True))
    raw = {
        "forward_splits": [{"id": "1", "process_date": "2021-01-01", "symbol": "aaa", "old_rate": "", "source_rate": "1", "new_rate": 4}],
        "name_changes": [{"id": "2", "process_date": "2020-01-02", "old_symbol": "AAA", "new_symbol": "BBB"}],
        "cash_mergers": [{"id": "3", "process_date": "2021-01-01", "effective_date": "2021-02-01", "acquiree_symbol": "DUP", "acquirer_symbol": "BAD"}],
        "cash_dividends": [{"id": "4", "process_date": "2015-01-01", "symbol": "BBB", "special": True}, {"id": "5", "process_date": "2021-01-01"}],
        "spin_offs": [{"id": "6", "process_date": "2021-01-01", "source_symbol": "AAA", "new_symbol": "ZZZ", "source_cusip": "c"}],
    }
    pages = spark.createDataFrame([(0, json.dumps({"corporate_actions": raw}))], "page_no long, body string")
    out = A.corporate_actions(P.action_rows(pages), e, SNAP)
    assert out.columns == S.ACTIONS.names
    got = {r["provider_event_id"]: r for r in out.collect()}
    status = {k: (r["security_id"], r["identity_match_status"], r["related_security_id"], r["related_identity_match_status"]) for k, r in got.items()}
    assert status == {
        "1": ("s6", "matched", None, "not_applicable"),
        "2": ("s1", "matched", "s2", "matched"),
        "3": (None, "ambiguous", None, "identity_quarantine"),
        "4": (None, "unmatched_date", None, "not_applicable"),
        "5": (None, "not_applicable", None, "not_applicable"),
        "6": ("s6", "matched", None, "unmatched_symbol"),
    }
    assert (got["1"]["old_rate"], got["1"]["new_rate"], got["1"]["requires_split_history_refresh"]) == ("1", "4", True)
    assert got["4"]["special"] is True and got["6"]["primary_cusip"] == "c"


def test_all_collections_and_bad_pages(spark):
    entry = [{"id": "x", "process_date": "2020-01-01"}]
    pages = lambda body: spark.createDataFrame([(0, json.dumps(body))], "page_no long, body string")
    every = P.action_rows(pages({"corporate_actions": {c: entry for c in P.ACTION_TYPES}}))
    assert sorted(r["action_type"] for r in every.collect()) == sorted(P.ACTION_TYPES.values()) and len(P.ACTION_TYPES) == 16
    for bad in ({"corporate_actions": {"magic": entry}}, {"corporate_actions": {"spin_offs": {}}}, {"corporate_actions": {"spin_offs": [1]}}, {"corporate_actions": [1]}):
        with pytest.raises(Exception, match="collection|array|object"):
            P.action_rows(pages(bad)).collect()
    with pytest.raises(ValueError, match="missing process_date"):
        A.corporate_actions(P.action_rows(pages({"corporate_actions": {"spin_offs": [{"id": "1"}]}})), episodes(spark), SNAP)


def test_action_refresh(spark, rows):
    assert A.refresh_start(None, SNAP) == dt.date(2016, 1, 1)
    table = lambda *r: spark.createDataFrame([(i, "forward_split", D(d), h, True) for i, d, h in r], "provider_event_id string, action_type string, process_date date, raw_payload_sha256 string, requires_split_history_refresh boolean")
    old = table(("1", "2026-01-01", "a"), ("2", "2026-09-01", "b"), ("3", "2026-09-05", "c"))
    assert A.refresh_start(old, SNAP) == D("2026-08-06") and A.refresh_start(old, D("2026-02-01")) == D("2026-01-02")
    new = table(("2", "2026-09-01", "B"), ("4", "2026-09-09", "d"))
    out = A.merged(old, new, D("2026-08-06"))
    assert rows(out, "provider_event_id", "raw_payload_sha256") == [("1", "a"), ("2", "B"), ("4", "d")]
    assert rows(A.merged(out, new, D("2026-08-06"))) == rows(out)
    assert rows(A.changed_splits(old, new)) == [("2",), ("4",)] and A.changed_splits(out, new).count() == 0
    assert rows(A.changed_splits(None, new)) == [("2",), ("4",)]
    with pytest.raises(ValueError, match="overlap_days"):
        A.refresh_start(old, SNAP, 0)


def bar_page(spark, no, bars):
    return spark.createDataFrame([(no, json.dumps({"bars": bars}))], "page_no long, body string")


def test_bars_map_and_quarantine(spark, rows):
    day = lambda d, c: {"t": f"{d}T05:00:00Z", "o": 1, "h": 2, "l": 0.5, "c": c, "v": 100, "vw": 1.5, "n": 7}
    raw = {"AAA": [day("2019-12-31", 8), day("2020-01-01", 8), day("2020-01-02", 4), {"t": "never"}], "dup": [day("2020-01-02", 1)], "BAD": [day("2020-01-02", 1)], "XXX": [day("2020-01-02", 1)], "ONE": [day("2020-01-02", 1)], "OLD": [day("2015-06-01", 1)]}
    split = {"AAA": [day("2019-12-31", 2), day("2020-01-01", 2), day("2020-01-02", 4)], "DUP": [day("2020-01-02", 1)], "BAD": [day("2020-01-02", 1)], "XXX": [day("2020-01-02", 1)], "OLD": [day("2015-06-01", 1)]}
    e = episodes(spark, ("s1", "AAA", "2016-01-01", "2019-12-31", True), ("s2", "AAA", "2020-01-02", None, True), ("s3", "DUP", None, None, True), ("s4", "DUP", None, None, True), ("s5", "BAD", None, None, False), ("s6", "ONE", None, None, True), ("s7", "OLD", None, None, True))
    asked = spark.createDataFrame([(s,) for s in ("AAA", "DUP", "BAD", "ONE", "OLD")], "symbol string")
    sides = [B.one_bar_per_day(P.bar_rows(bar_page(spark, 0, b), s)) for b, s in ((raw, "raw"), (split, "split_adjusted"))]
    out = B.as_bars(B.mapped_bars(B.paired(*sides), e, asked), SNAP).cache()
    assert out.columns == S.BARS.names and out.schema["raw_trade_count"].dataType == S.BARS["raw_trade_count"].dataType
    assert rows(out, "symbol", "date", "identity_status", "security_id") == sorted(
        [
            ("AAA", D("2019-12-31"), "mapped", "s1"),
            ("AAA", D("2020-01-01"), "outside_symbol_episode", None),
            ("AAA", D("2020-01-02"), "mapped", "s2"),
            ("BAD", D("2020-01-02"), "identity_quarantine", "s5"),
            ("DUP", D("2020-01-02"), "ambiguous_episode_overlap", None),
            ("OLD", D("2015-06-01"), "outside_symbol_episode", None),
            ("ONE", D("2020-01-02"), "missing_adjustment_pair", "s6"),
            ("XXX", D("2020-01-02"), "unexpected_returned_symbol", None),
        ],
        key=str,
    )
    assert B.safe(out).count() + B.quarantined(out).count() == out.count()
    gate = B.pilot_gate(B.safe(out), B.quarantined(out)).first()
    assert gate["pilot_passed"] and (gate["row_count"], gate["split_adjustment_difference_count"], gate["quarantine_row_count"]) == (2, 1, 6)
    assert not B.pilot_gate(out, B.quarantined(out)).first()["pilot_passed"]


def test_bar_repeats_and_bad_pages(spark):
    b = lambda c: [{"t": "2020-01-02T05:00:00Z", "c": c}]
    pages = bar_page(spark, 0, {"A": b(1) + b(2)}).unionByName(bar_page(spark, 1, {"a": b(3)}))
    assert [r["raw_close"] for r in B.one_bar_per_day(P.bar_rows(pages, "raw")).collect()] == [3.0]


def test_bar_update(spark, rows):
    symbols = spark.createDataFrame([("A",), ("B",), ("C",)], "symbol string")
    actions = spark.createDataFrame([("1", "a", True), ("2", "Z", True), ("3", None, True), ("4", "B", False)], "provider_event_id string, primary_symbol string, requires_split_history_refresh boolean")
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "provider_event_id string")
    pending = B.pending_splits(ids("1", "2", "3", "9"), ids("9"), actions).cache()
    assert rows(pending) == sorted([("1", "A"), ("2", "Z"), ("3", None)], key=str)
    plan = B.update_plan(symbols, D("2026-09-10"), pending.filter("symbol is not null"))
    assert rows(plan) == [("A", D("2016-01-01")), ("B", D("2026-09-03")), ("C", D("2026-09-03"))]
    assert rows(B.applied_after("update", ids("9"), pending, actions)) == [("1",), ("2",), ("3",), ("9",)]
    assert rows(B.applied_after("backfill", ids("9"), pending, actions)) == [("1",), ("2",), ("3",)]
    bars = lambda *r: spark.createDataFrame([(s, D(d), c) for s, d, c in r], "symbol string, date date, c int")
    old = bars(("A", "2020-01-01", 1), ("B", "2026-09-01", 1), ("B", "2026-09-04", 1), ("D", "2026-09-04", 1))
    new = bars(("A", "2020-01-01", 2), ("B", "2026-09-04", 2))
    out = B.replaced(old, new, plan)
    assert rows(out) == sorted([("A", D("2020-01-01"), 2), ("B", D("2026-09-01"), 1), ("B", D("2026-09-04"), 2), ("D", D("2026-09-04"), 1)], key=str)
    assert rows(B.replaced(out, new, plan)) == rows(out)
    assert [r["batch_no"] for r in B.batches(symbols, 2).orderBy("symbol").collect()] == [0, 0, 1]
    tickers = symbols.select(F.lit("NVDA").alias("provider_symbol")).unionByName(spark.createDataFrame([("aapl",), ("OTHER",)], "provider_symbol string"))
    assert [r["symbol"] for r in B.pilot_symbols(tickers).orderBy("place").collect()] == ["AAPL", "NVDA"]


def audit_case(spark):
    names = [case[0] for case in U.CASES]
    held = [(f"s{k}", n, k < 4, None if k < 4 else "2022-10-27", True) for k, n in enumerate(names)]
    held += [("x1", "SYMC", False, "2019-11-05", True), ("x1", "GEN", True, None, True), ("x2", "CTL", False, "2020-09-18", True), ("x2", "LUMN", True, None, True)]
    held += [(f"r{k}", f"R{k}", False, f"202{4 + k % 2}-0{1 + k % 8}-15", True) for k in range(9)] + [(f"o{k}", f"O{k}", False, f"201{7 + k % 2}-0{1 + k % 8}-15", True) for k in range(9)]
    m = master(spark, *held, *[(f"d{k}", f"D{k // 2}", True, None, True) for k in range(14)])
    return m.withColumn("symbol_identity_conflict", F.col("symbol").startswith("D"))


def test_audit_sample(spark, rows):
    m = audit_case(spark)
    e = spark.createDataFrame([("x1", "NLOK", D("2019-11-05"), D("2022-11-07"), False), ("x1", "GEN", D("2022-11-08"), None, True)], "security_id string, symbol string, symbol_valid_from date, symbol_valid_to date, is_current_symbol boolean")
    sample = U.audit_sample(m, D("2026-09-10"), e).cache()
    U.require_all_categories(sample)
    assert sample.columns == S.AUDIT_SAMPLE.names
    assert rows(sample) == rows(U.audit_sample(m.orderBy(F.desc("symbol")), D("2026-09-10"), e))
    got = {r["symbol"]: r for r in sample.collect()}
    assert sample.filter("sample_categories like '%recent_delisting%'").count() == 4 == sample.filter("sample_categories like '%older_delisting%'").count()
    assert sample.filter("sample_roles = 'ambiguous'").count() == 10
    assert (got["NLOK"]["sample_categories"], got["NLOK"]["sample_roles"], got["NLOK"]["symbol_valid_to"]) == ("ticker_change", "expected_end;expected_start", D("2022-11-07"))
    assert (got["GEN"]["known_event_date"], got["GEN"]["sample_roles"]) == (D("2019-11-05"), "expected_start")
    with pytest.raises(ValueError, match="missing required categories"):
        U.require_all_categories(sample.filter("sample_categories not like '%ticker%'"))


def test_audit_report_and_gate(spark):
    sample = spark.createDataFrame(
        [
            ("1", "s1", "AAPL", True, "active;forward_split", "event_both_sides;full_window", D("2020-08-31"), None, None),
            ("2", "s2", "LATE", True, "active", "full_window", None, None, None),
            ("3", "s3", "OLD", False, "older_delisting", "expected_end", D("2019-01-10"), None, None),
            ("4", "s4", "NEWNAME", False, "ticker_change", "expected_end;expected_start", None, D("2017-01-01"), D("2018-01-01")),
            ("5", "s5", "DUP", False, "ticker_reuse", "ambiguous", None, None, None),
            ("6", "s6", "NONE", False, "older_delisting", "expected_end", D("2019-01-10"), None, None),
        ],
        "sample_id string, security_id string, symbol string, active boolean, sample_categories string, sample_roles string, known_event_date date, symbol_valid_from date, symbol_valid_to date",
    ).withColumns({"company_name": F.lit("x"), "delisted_date": F.lit(None).cast("date"), "has_alpaca_asset": F.lit(True), "symbol_identity_conflict": F.lit(False), "known_event_type": F.lit(None).cast("string")})
    seen = [("sip", "AAPL", "AAPL", d, 200) for d in ("2016-01-04", "2020-08-28", "2020-08-31", "2026-09-09")] + [("iex", "AAPL", "AAPL", "2026-09-09", 10)]
    seen += [("sip", "LATE", "LATE", "2018-01-01", 1), ("sip", "OLD", "OLD", "2018-01-01", 1), ("sip", "DUP", "DUP", "2018-01-01", 1)]
    seen += [("sip", "NEWNAME", "NEWNAME", d, 1) for d in ("2017-01-03", "2017-12-29", "2019-01-01")] + [("sip", "NONE", "OTHER", "2018-01-01", 1)]
    observations = spark.createDataFrame([(f, a, b, D(d), v) for f, a, b, d, v in seen], "feed string, requested string, returned string, date date, volume long")
    results = observations.groupBy("feed", "requested").agg(F.array_sort(F.collect_set("returned")).alias("returned_symbols"), F.lit(None).cast("string").alias("request_error"))
    report = U.coverage_report(sample, observations, results, SNAP, D("2026-09-10"), D("2026-06-12")).cache()
    assert report.columns == S.AUDIT.names
    got = {r["symbol"]: (r["audit_status"], r["coverage_reason"]) for r in report.collect()}
    assert got == {
        "AAPL": ("pass", None),
        "LATE": ("fail", "truncated_start;active_history_stale"),
        "OLD": ("fail", "truncated_end"),
        "NEWNAME": ("warning", "bars_outside_episode"),
        "DUP": ("fail", "ambiguous_reused_symbol"),
        "NONE": ("fail", "returned_under_different_symbol;no_bars"),
    }
    apple = next(r for r in report.collect() if r["symbol"] == "AAPL")
    assert (apple["sip_to_iex_volume_ratio"], apple["pre_event_bar_count"], apple["post_event_bar_count"]) == (20.0, 2, 2)
    s = U.coverage_summary(report).first()
    assert (s["delisted_sample_count"], s["delisted_coverage_count"], s["ticker_change_coverage_adequate"], s["sip_volume_exceeds_iex"]) == (3, 1, True, True)
    assert s["backfill_recommendation_reason"] == "delisted_coverage_below_80_pct;symbol_remapping_observed"
    assert U.coverage_summary(report.limit(0)).first()["backfill_recommendation_reason"] == "empty_audit_sample"
    good = U.coverage_summary(report.filter("symbol in ('AAPL', 'NEWNAME')")).first()
    assert (good["backfill_recommendation"], good["backfill_recommendation_reason"]) == ("proceed", "audit_gate_passed")


def test_html_tables(spark, rows):
    page = """<table><tr><td>nothing</td></tr></table><table><tr><th>Name</th><th>RTC&nbsp;Ticker</th></tr><tr><td>A</td><td>aaa, BBB/ccc</td></tr><tr><td>B</td><td>N/A</td></tr><tr><td>short</td></tr></table>
    <table><tr><th>Symbol</th><th>GICS Sector</th><th>GICS Sub‑Industry</th></tr><tr><td><a>X.Y</a></td><td> Tech </td><td>Soft<b>ware</b></td></tr><tr><td>X-Y</td><td>a</td><td>b</td></tr></table>"""
    cells = H.html_cells(spark.createDataFrame([("p", page), ("q", None), ("r", "")], "doc string, html string")).cache()
    assert rows(H.ticker_symbols(cells)) == [(x,) for x in "A AAA BBB CCC N RTC X-Y X.Y".split()]  # cells are split before they are compared
    assert rows(H.classifications(cells)) == [("X.Y", "X-Y", "Tech", "Soft ware")]


def test_landed_listings_fail_on_shape(spark, rows):
    pages = lambda *b: spark.createDataFrame(list(enumerate(b)), "page_no long, body string")
    good = P.listing_rows(pages('{"results":[{"ticker":"A","active":true},5]}', "{}", '{"results":null}'))
    assert rows(good, "ticker", "active") == [("A", "true")]
    with pytest.raises(Exception, match="must be an array"):
        P.listing_rows(pages('{"results":{"a":1}}')).collect()


def test_audit_envelopes(spark, rows):
    body = [{"request": {"symbols": ["A"], "feed": "sip"}, "response": {"bars": {"A": [{"t": "2020-01-02T05:00:00Z", "v": 5.0}, {"t": "x"}], "B": [{"t": "2020-01-03", "v": None}]}}}, {"request": {"symbols": ["C"], "feed": "iex"}, "error": "boom"}]
    seen, results = P.audit_rows(spark.createDataFrame([(i, json.dumps(b)) for i, b in enumerate(body)], "page_no long, body string"))
    assert rows(seen) == [("sip", "A", "A", D("2020-01-02"), 5), ("sip", "A", "B", D("2020-01-03"), 0)]
    assert rows(results) == [("iex", "C", [], "boom"), ("sip", "A", ["A", "B"], None)]


def test_metrics(spark, rows):
    df = spark.createDataFrame([("a", "2020-01-01", 1), ("a", "2020-01-02", 1), ("b", "2020-01-02", 2), ("b", "bad", 2), (None, None, 3)], "s string, d string, k int")
    row = M.frame_state(df, ["k"], ["s", "missing"], "d", "s", 4).first()
    assert row.asDict() == {"row_count": 5, "s_count": 2, "missing_required_columns": ["missing"], "min_date": "2020-01-01", "max_date": "2020-01-02", "duplicate_key_count": 4, "latest_date": "2020-01-02", "latest_date_coverage_count": 2, "latest_date_coverage_pct": 0.5}
    assert M.duplicate_keys(df, ["nope"]).first()[0] is None and M.duplicate_keys(df.limit(0), ["k"]).first()[0] == 0
    assert rows(M.dimension_entities(df, "k", "s")) == [("1", 1), ("2", 1)]


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(ValueError, match="x missing required columns: \\['z'\\]"):
        V.require_columns(df, ["k", "z"], "x")
    with pytest.raises(ValueError, match="not unique"):
        V.require_unique(df, ["k"], "x")
    V.require_unique(df, ["k", "v"], "x")
    with pytest.raises(ValueError, match="mode"):
        V.require_one_of("sometimes", ("pilot",), "mode")
