"""Publishing by parts and one pointer: readers, crashes at each step, touched parts, vacuum."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import bars as B
from ledgerloom.operators import episodes as E
from ledgerloom.plans import publish as O
from ledgerloom.sources import tables as T

DAY = dt.date(2020, 1, 1)
PLAIN = O.Dataset("x.plain", "x", "replace_snapshot", "all", ["id"], sort=["id"])
PLAIN_STATE = O.Dataset("x.state", "x", "replace_snapshot", "all", ["part", "symbol"], sort=["part", "symbol"])
BARS = O.Dataset("x.bars", "x", "incremental_merge", "all", ["symbol", "date"], "date", "symbol", ["symbol", "date"], "yyyy-MM", 4)


def table(spark, n, start=0):
    return spark.range(start, start + n).withColumn("v", F.col("id") % 7)


def test_tables_switch_together_and_crashes_show_nothing(spark, tmp_path, monkeypatch):
    base = str(tmp_path / "d")
    with pytest.raises(FileNotFoundError, match="master not found"):
        T.required_table(spark, base, "a", "master")
    with pytest.raises(FileNotFoundError):
        T.published(spark, base, "a")
    O.publish({"a": (table(spark, 5), PLAIN, {"run": 1}), "b": (table(spark, 3), PLAIN, {})}, base)
    seen = lambda: tuple(T.required_table(spark, base, n, n).count() for n in "ab")
    assert seen() == (5, 3)
    old = T.published(spark, base, "a")  # a reader that has begun
    new = {"a": (table(spark, 50), PLAIN, {"run": 2}), "b": (table(spark, 30), PLAIN, {})}
    for step in ("_write_parts", "state", "switch", "_put"):
        real, calls = getattr(O, step), []

        def broken(*args, real=real, calls=calls):
            calls.append(1)
            if len(calls) == 2 or step == "switch":
                raise OSError("lost")
            return real(*args)

        monkeypatch.setattr(O, step, broken)
        with pytest.raises(OSError, match="lost"):
            O.publish(new, base)
        monkeypatch.undo()
        assert seen() == (5, 3)
    between, write = [], O._write_parts
    monkeypatch.setattr(O, "_write_parts", lambda *a: (between.append(seen()), write(*a))[1])
    O.publish(new, base)
    monkeypatch.undo()
    assert between == [(5, 3), (5, 3)] and seen() == (50, 30) and old.count() == 5
    assert T.metadata(spark, base, "a", "run long, row_count long, none string").first() == (2, 50, None)
    O.publish({"c": (table(spark, 0), PLAIN, {})}, base)
    assert seen() == (50, 30) and T.published(spark, base, "c").columns == ["id", "v"]
    gone = O.vacuumed(spark, base, keep=1)
    assert seen() == (50, 30) and len(gone) >= 5 and O.vacuumed(spark, base, keep=1) == []
    assert T.published(spark, base, "c").count() == 0


def test_an_update_rewrites_touched_parts_only(spark, tmp_path, rows):
    base = str(tmp_path / "bars")
    r = random.Random(1)
    history = [(f"S{s}", DAY + dt.timedelta(d), r.random()) for s in range(12) for d in range(0, 180, 3)]
    schema = "symbol string, date date, close double"
    O.publish({"bars": (spark.createDataFrame(history, schema), BARS, {})}, base)
    before = T.current(spark, base)["tables"]["bars"]["parts"]
    assert len(before) == 6 * len({k.rsplit("-", 1)[1] for k in before})
    assert rows(T.published(spark, base, "bars")) == sorted(history, key=str)
    plan = [(f"S{s}", DAY + dt.timedelta(170)) for s in range(12)]
    plan[5] = ("S5", DAY)  # a split: the whole history again
    fresh = [(s, d, 9.0) for s, since in plan for d in (since, DAY + dt.timedelta(175), DAY + dt.timedelta(200))]
    new, asked = spark.createDataFrame(fresh, schema), spark.createDataFrame(plan, "symbol string, start_date date")
    touched = set(O.touched_parts(asked, BARS, "symbol", "start_date", list(before)))
    touched |= {x[0] for x in new.select(O.part_of(BARS, F.col("date"), F.col("symbol"))).collect()}
    rest = B.replaced(T.published(spark, base, "bars", parts=sorted(touched)), new, asked)
    entry = O.publish({"bars": (rest, BARS, {})}, base, {"bars": sorted(touched)})["bars"]
    since = dict(plan)
    want = [x for x in history if x[1] < since[x[0]]] + fresh
    assert rows(T.published(spark, base, "bars")) == sorted(want, key=str)
    after = entry["parts"]
    rewritten = {k for k in after if before.get(k) != after[k]}
    bucket = new.filter("symbol = 'S5'").select(O.part_of(BARS, F.col("date"), F.col("symbol"))).first()[0].rsplit("-", 1)[1]
    assert rewritten == {k for k in after if k >= "2020-06" or k.endswith(f"-{bucket}")} and len(rewritten) < len(after) / 2 + 3
    assert entry["metadata"]["row_count"] == len(want) and entry["metadata"]["max_date"] == str(DAY + dt.timedelta(200))
    # a part whose rows are all gone is no part any more
    empty = O.publish({"bars": (rest.filter("false"), BARS, {})}, base, {"bars": ["2020-06-0"]})["bars"]["parts"]
    assert "2020-06-0" not in empty and set(empty) == set(after) - {"2020-06-0"}


def test_manifest_folds_digests(spark, tmp_path):
    """The manifest follows the files' contents, not their names or number of tasks."""
    pages = spark.createDataFrame([(f"page {k}",) for k in range(40)], "body string").repartition(8, "body")
    one, two = (O.land_text(pages, str(tmp_path / n), "p", "https://h/x").first() for n in "ab")
    other = O.land_text(pages.filter("body <> 'page 3'"), str(tmp_path / "c"), "p", "https://h/x").first()
    assert one["sha256"] == two["sha256"] != other["sha256"] and (one["page_count"], other["page_count"]) == (40, 39)


def test_tickers_take_the_newest_listing(spark):
    """Several master rows of a security: the exact symbol's newest row counts, else the security's."""
    episode = "episode_id string, security_id string, symbol string, is_price_coverage_eligible boolean, is_current_symbol boolean, symbol_valid_to date"
    fields = "security_id string, symbol string, active boolean, last_updated_utc string, sector string, industry string, alpaca_asset_id string, alpaca_status string, alpaca_tradable boolean, is_known_reit boolean"
    master = spark.createDataFrame(
        [("s", "A", False, "2020", "old", None, "1", None, None, False), ("s", "A", True, "2019", "new", None, "2", None, None, False), ("s", "B", True, None, "b", None, "3", None, None, False), ("s", "C", None, "2030", "c", None, "4", None, None, True)],
        fields,
    )
    episodes = spark.createDataFrame([("1", "s", "A", True, True, None), ("2", "s", "Z", True, False, DAY), ("3", "s", "C", True, False, None), ("4", "s", "B", False, False, None)], episode)
    from ledgerloom import schemas as S

    full = episodes
    for f in S.EPISODES.fields:
        if f.name not in full.columns:
            full = full.withColumn(f.name, F.lit(None).cast(f.dataType))
    got = {r["episode_id"]: (r["sector"], r["alpaca_asset_id"]) for r in E.episode_tickers(full, master).collect()}
    assert got == {"1": ("new", "2"), "2": ("new", None), "3": ("c", "4")}


def test_states_of_parts_add_up(spark, tmp_path):
    """After three updates the merged states give the metrics that a full recount gives."""
    base = str(tmp_path / "state")
    r = random.Random(2)
    schema = "symbol string, date date, security_id string, raw_close double, split_adjusted_close double"
    bar = lambda s, d: (f"S{s}", DAY + dt.timedelta(d), r.choice([f"id{s}", f"id{s}b", None]), r.choice([None, 1.0, 2.0]), r.choice([None, 2.0]))
    history = [bar(s, d) for s in range(8) for d in range(0, 120, 4)] * 1 + [bar(1, 8)]
    part = O.part_of(BARS, F.col("date"), F.col("symbol"))
    rows = spark.createDataFrame(history, schema)
    O.publish({"bars": (rows, BARS, {}), "state": (B.symbol_state(rows, part), PLAIN_STATE, {})}, base)
    for turn in range(3):
        plan = spark.createDataFrame([(f"S{s}", DAY + dt.timedelta(90 + 10 * turn)) for s in range(turn, 8)], "symbol string, start_date date")
        fresh = spark.createDataFrame([bar(s, 95 + 10 * turn + k) for s in range(turn, 8) for k in range(3)], schema)
        known = list(T.current(spark, base)["tables"]["bars"]["parts"])
        touched = sorted({*O.touched_parts(plan, BARS, "symbol", "start_date", known), *(x[0] for x in fresh.select(part).collect())})
        rows = B.replaced(T.published(spark, base, "bars", parts=touched), fresh, plan)
        state = T.published(spark, base, "state").filter(~F.col("part").isin(touched)).unionByName(B.symbol_state(rows, part))
        counts = B.state_metrics(state).first().asDict()
        done = O.publish({"bars": (rows, BARS, counts), "state": (state, PLAIN_STATE, {})}, base, {"bars": touched})
        whole = T.published(spark, base, "bars")
        assert counts == B.bar_metrics(whole).first().asDict()
        about = O.state(whole, BARS, whole.columns)
        assert all(done["bars"]["metadata"][k] == v for k, v in about.items() if k != "generated_at_utc")


def test_states_of_symbols_take_one_shuffle(spark):
    """Repeated keys, missing prices and securities of a part and symbol, in one shuffle."""
    data = [("A", dt.date(2020, 1, 1), 1.0, 1.0, "x"), ("A", dt.date(2020, 1, 1), 2.0, None, "y"), ("A", dt.date(2020, 1, 2), 3.0, 4.0, "x"), ("B", dt.date(2020, 1, 1), 1.0, 1.0, None)]
    got = B.symbol_state(spark.createDataFrame(data, "symbol string, date date, raw_close double, split_adjusted_close double, security_id string"), F.date_format("date", "yyyy"))
    assert sorted(map(tuple, got.select("symbol", "rows", "repeated", "missing", "differing", "securities").collect())) == [("A", 3, 2, 1, 1, ["x", "y"]), ("B", 1, 0, 0, 0, [])]
    assert got._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
