"""Rename chains and overlaps against the sequential rules, on random and on long inputs."""

import collections
import datetime as dt
import random

from ledgerloom.operators import episodes as E

SNAP = dt.date(2021, 1, 1)
DAY = dt.date(2020, 1, 1)
MASTER = "security_id string, symbol string, active boolean, delisted_date date"
CHANGES = "event_id string, process_date date, old_symbol string, new_symbol string"


def walked(master, changes):
    """The rule, one security and one step at a time."""
    out = []
    held = collections.defaultdict(list)
    for s, symbol, active, gone in master:
        held[s].append((symbol, active, gone))
    for s, own in held.items():
        active = [x[0] for x in own if x[1]]
        cursor = active[0] if len(active) == 1 else max(own, key=lambda x: (x[1], x[2] is None, x[2] or DAY, x[0]))[0]
        boundary, seen, step = SNAP + dt.timedelta(1), {cursor}, 0
        while True:
            may = [c for c in changes if c[3] == cursor and c[1] < boundary]
            if not may:
                break
            mine = [c for c in may if c[2] in {x[0] for x in own}]
            _, day, old, _ = mine[0] if len(mine) == 1 else min(may, key=lambda c: (-c[1].toordinal(), c[0], c[2]))
            step += 1
            out.append((s, step, cursor, old, day))
            if old in seen:
                break
            seen.add(old)
            cursor, boundary = old, day
    return sorted(out)


def test_walks_against_the_sequential_rule(spark, rows):
    for seed, names, events in ((1, 6, 60), (2, 25, 120), (3, 3, 25)):
        r = random.Random(seed)
        symbol = lambda: f"N{r.randrange(names)}"
        changes = [(f"e{i:03}", DAY + dt.timedelta(r.randrange(40)), symbol(), symbol()) for i in range(events)]
        changes = [c for c in changes if c[2] != c[3]]
        master = sorted({(f"s{i % 40}", symbol()) for i in range(90)})
        master = [(s, n, r.random() < 0.4, None if r.random() < 0.5 else DAY + dt.timedelta(r.randrange(9))) for s, n in master]
        got = E.chains(spark.createDataFrame(master, MASTER), spark.createDataFrame(changes, CHANGES), SNAP)
        assert rows(got, "security_id", "step", "cursor", "old", "day") == sorted(walked(master, changes), key=str)


def test_a_long_chain_takes_few_rounds(spark, monkeypatch):
    """5,000 renames in a row are walked in rounds that grow with the logarithm; two securities, one with a step of its own."""
    n = 5000
    first = dt.date(2000, 1, 1)
    changes = [(f"e{k:05}", first + dt.timedelta(k), f"N{k}", f"N{k + 1}") for k in range(n)]
    master = [("long", f"N{n}", True, None), ("own", f"N{n}", True, None), ("own", "N4000", False, first), ("none", "Z", True, None)]
    tables, write = [], E.written
    monkeypatch.setattr(E, "written", lambda df, name: tables.append(name) or write(df, name))
    got = E.chains(spark.createDataFrame(master, MASTER), spark.createDataFrame(changes, CHANGES), SNAP).groupBy("security_id").count().collect()
    assert {r["security_id"]: r["count"] for r in got} == {"long": n, "own": n}
    assert len(tables) < 2 * 15 + 6


def test_overlaps_are_swept_not_paired(spark, rows):
    r = random.Random(3)
    day = lambda p: None if r.random() < p else DAY + dt.timedelta(r.randrange(40))
    data = [(f"e{i}", f"s{r.randrange(4)}", f"Y{r.randrange(300)}", day(0.05), day(0.15), "bounded", True) for i in range(1000)]
    data += [("x1", None, "Y1", DAY, None, "bounded", True), ("x2", "s1", None, DAY, None, "bounded", True), ("x3", "s2", None, DAY, None, "bounded", True)]
    df = spark.createDataFrame(data, "episode_id string, security_id string, symbol string, symbol_valid_from date, symbol_valid_to date, episode_status string, is_episode_mapping_eligible boolean")

    def meet(a, b):
        if None in (a[1], b[1], a[2], b[2]) or a[1] == b[1] or a[2] != b[2]:
            return False
        return None in (a[3], b[3]) or ((b[4] is None or a[3] <= b[4]) and (a[4] is None or b[3] <= a[4]))

    marked = E.mark_overlaps(df)
    got = {x["episode_id"]: (x["episode_status"], x["is_episode_mapping_eligible"]) for x in marked.collect()}
    assert got == {a[0]: ("unresolved", False) if any(meet(a, b) for b in data) else ("bounded", True) for a in data}
    plan = E.mark_overlaps(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1
    assert marked.columns == df.columns and E.mark_overlaps(df.filter("false")).count() == 0


def test_repeats_combine_before_the_shuffle(spark):
    """The last row of a key is an aggregate with a partial step, not a sort of whole rows."""
    changes = spark.createDataFrame([("e", DAY, "A", "B")] * 3 + [(None, None, "A", "B"), (None, DAY, "C", "B")], CHANGES)
    last = E.one_per_event(changes)
    assert "partial_max_by" in last._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, last.collect()), key=str) == sorted([("e", DAY, "A", "B"), (None, None, "A", "B")], key=str)


def test_only_walks_with_a_step_of_their_own_are_walked_again(spark, monkeypatch):
    """A rename away from a security's own symbol is off its way back: no state of it is listed for the security."""
    changes = [(f"e{k}", DAY + dt.timedelta(k), f"N{k}", f"N{k + 1}") for k in range(6)]
    master = [(f"s{k}", f"N{k}", True, None) for k in range(6)]
    tables, write = [], E.written
    monkeypatch.setattr(E, "written", lambda df, name: tables.append(name) or write(df, name))
    got = E.chains(spark.createDataFrame(master, MASTER), spark.createDataFrame(changes, CHANGES), SNAP)
    assert {r["security_id"]: r["count"] for r in got.groupBy("security_id").count().collect()} == {f"s{k}": k for k in range(1, 6)}
    assert "walk-breaks" in tables and "walk-own" not in tables and len(tables) < 9


def test_episodes_are_counted_in_one_pass(spark):
    from ledgerloom.operators import metrics as M

    e = spark.createDataFrame([("current", True, True, True), ("unresolved", False, True, False)], "episode_status string, is_current_symbol boolean, is_price_coverage_eligible boolean, is_episode_mapping_eligible boolean")
    got = M.episode_counts(e, resolved_current_count="episode_status = 'current'")
    assert got.select("unresolved_episode_count", "resolved_current_count").first() == (1, 1)
    assert "Join" not in got._jdf.queryExecution().executedPlan().toString()
