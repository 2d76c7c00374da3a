"""The five dataset jobs: from landed pages to published tables."""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import actions as A
from ..operators import audit as U
from ..operators import bars as B
from ..operators import episodes as E
from ..operators import identity as I
from ..operators import metrics as M
from ..operators.validate import require_at_least, require_one_of, require_unique
from ..sources import html_tables as H
from ..sources import pages as P
from ..sources.tables import bar_state, current, is_published, published, required_table
from .publish import Dataset, part_of, publish, touched_parts

#: Parts of the bar tables: one for each month and bucket of symbols. An update rewrites the last months and, of split symbols,
#: their buckets.
PERIOD, BUCKETS = "yyyy-MM", 8
MASTER = Dataset("reference.security_master", "reference", "replace_snapshot", "us_common_stocks_active_and_delisted", ["security_id", "symbol"], entity="security_id", sort=["symbol", "security_id"])
TICKERS = Dataset("reference.tickers", "reference", "replace_snapshot", "alpaca_price_coverage_active_and_delisted_common_stocks", ["episode_id"], entity="security_id", sort=["provider_symbol"])
EXCLUSIONS = Dataset("reference.universe_exclusions", "reference", "replace_snapshot", "us_common_stock_universe_exclusions", ["security_id", "symbol"], entity="security_id", sort=["symbol", "security_id"])
EPISODES = Dataset("reference.symbol_episodes", "reference", "replace_snapshot", "historical_symbol_identity_timeline", ["episode_id"], entity="security_id", sort=["security_id", "symbol_valid_from", "symbol"])
ACTIONS = Dataset("reference.corporate_actions", "reference", "overlapping_incremental_replace", "alpaca_us_corporate_actions_from_2016", ["provider_event_id"], "process_date", "security_id", ["process_date", "action_type", "provider_event_id"])
SPLIT_REFRESH = Dataset("reference.split_refresh", "reference", "replace_snapshot", "splits_whose_bar_history_must_be_read_again", ["provider_event_id"], sort=["provider_event_id"])
APPLIED_SPLITS = Dataset("market.daily_bars.applied_splits", "market", "replace_snapshot", "splits_that_the_bar_history_holds", ["provider_event_id"], sort=["provider_event_id"])
HISTORICAL = Dataset("market.daily_bars.historical", "market", "incremental_merge", "episode_bounded_raw_and_split_adjusted_daily_bars", ["symbol", "date"], "date", "security_id", ["symbol", "date"], PERIOD, BUCKETS)
QUARANTINE = Dataset("market.daily_bars.identity_quarantine", "market", "incremental_merge", "unmapped_or_ambiguous_alpaca_daily_bars", ["symbol", "date"], "date", "symbol", ["symbol", "date"], PERIOD, BUCKETS)
BAR_STATE = Dataset("market.daily_bars.symbol_state", "market", "replace_snapshot", "counts_of_every_part_and_symbol", ["part", "symbol"], sort=["part", "symbol"])
AUDIT = Dataset("reference.alpaca_coverage_audit", "reference", "replace_snapshot", "historical_coverage_audit_sample", ["sample_id"], entity="security_id", sort=["symbol", "security_id"])


def _row(df: DataFrame) -> dict:
    return df.first().asDict()


def run_security_master(spark: SparkSession, listings: str, assets: str, directory: str, snapshot: dt.date, reit_html: str | None = None, classification_html: str | None = None, history_start: dt.date = S.HISTORY_START) -> dict[str, str]:
    """Publish security_master, tickers and universe_exclusions from landed listing, asset and HTML pages."""
    cells = lambda path: H.html_cells(H.landed_html(spark, path))
    master = I.security_master(
        P.listing_rows(P.landed_pages(spark, listings)),
        P.asset_rows(P.landed_pages(spark, assets)),
        snapshot,
        H.ticker_symbols(cells(reit_html)) if reit_html else None,
        H.classifications(cells(classification_html)) if classification_html else None,
        history_start,
    ).persist()
    gone = I.exclusions(master)
    base = {"snapshot_date": snapshot.isoformat(), "history_start_date": history_start.isoformat(), "eligible_exchanges": sorted(I.ELIGIBLE_EXCHANGES)}
    reasons = {r["reason"]: r["rows"] for r in M.reason_counts(gone, "exclusion_reason").orderBy("reason").collect()}
    tickers = I.pending_tickers(master)
    try:
        return publish(
            {
                "security_master": (master, MASTER, base | _row(M.security_master_counts(master))),
                "tickers": (tickers, TICKERS, base | _row(M.flag_counts(tickers, active_count="active", inactive_count="not active"))),
                "universe_exclusions": (gone, EXCLUSIONS, base | {"exclusion_counts": reasons}),
            },
            directory,
        )
    finally:
        master.unpersist()


def run_symbol_episodes(spark: SparkSession, name_changes: str, directory: str, snapshot: dt.date, history_start: dt.date = S.HISTORY_START) -> dict[str, str]:
    """Publish symbol_episodes and the dated tickers from landed name-change pages and the security master."""
    master = required_table(spark, directory, "security_master", "security master")
    changes = E.one_per_event(P.name_change_rows(P.landed_pages(spark, name_changes)))
    episodes = E.symbol_episodes(master, changes, snapshot, history_start).persist()
    tickers = E.episode_tickers(episodes, master).persist()
    base = {"snapshot_date": snapshot.isoformat(), "history_start_date": history_start.isoformat()}
    try:
        return publish({"symbol_episodes": (episodes, EPISODES, base | _row(M.episode_counts(episodes))), "tickers": (tickers, TICKERS, base | _row(M.ticker_counts(tickers)))}, directory)
    finally:
        episodes.unpersist()
        tickers.unpersist()


def run_corporate_actions(spark: SparkSession, pages: str, directory: str, snapshot: dt.date, overlap_days: int = A.OVERLAP_DAYS, history_start: dt.date = S.HISTORY_START) -> dict[str, str]:
    """Merge landed action pages into corporate_actions; split_refresh lists the splits whose bars must be read again."""
    require_at_least(overlap_days, 1, "overlap_days")
    episodes = required_table(spark, directory, "symbol_episodes", "symbol episodes")
    symbols = _row(episodes.agg(F.count_distinct("symbol").alias("symbol_count"), F.sha2(F.array_join(F.array_sort(F.collect_set(F.upper("symbol"))), "\n"), 256).alias("symbols_sha256")))
    if not symbols["symbol_count"]:
        raise ValueError("symbol episodes contain no symbols")
    existing = published(spark, directory, "corporate_actions") if is_published(spark, directory, "corporate_actions") else None
    end = snapshot - dt.timedelta(days=1)
    start = A.refresh_start(existing, end, overlap_days, history_start)
    fresh = A.corporate_actions(P.action_rows(P.landed_pages(spark, pages)), episodes, snapshot).filter(F.col("process_date") >= F.lit(start)).persist()
    table = A.merged(existing, fresh, start)
    changed = A.changed_splits(existing, fresh).persist()
    counts = {r["action_type"]: r["events"] for r in M.action_counts(table).collect()}
    extra = {"snapshot_date": snapshot.isoformat(), "refresh_start_date": start.isoformat(), "refresh_end_date": end.isoformat(), "overlap_days": overlap_days, "action_type_counts": counts, "split_history_refresh_event_count": changed.count()} | symbols
    extra |= _row(M.flag_counts(table, matched_event_count="security_id is not null", unmatched_event_count="security_id is null"))
    try:
        return publish({"corporate_actions": (table, ACTIONS, extra), "split_refresh": (changed, SPLIT_REFRESH, {"snapshot_date": snapshot.isoformat()})}, directory)
    finally:
        changed.unpersist()
        fresh.unpersist()


def plan_daily_bars(spark: SparkSession, mode: str, directory: str, bars_directory: str, overlap_days: int = B.OVERLAP_DAYS, start: dt.date | None = None, history_start: dt.date = S.HISTORY_START) -> DataFrame:
    """(symbol, start_date): what a run of `mode` (pilot, backfill, update) has to read."""
    require_one_of(mode, ("pilot", "backfill", "update"), "mode")
    tickers = required_table(spark, directory, "tickers", "tickers")
    symbols = tickers.select(F.upper("provider_symbol").alias("symbol")).filter("symbol is not null").distinct()
    if mode == "pilot":
        symbols = B.pilot_symbols(tickers).select("symbol")
    if mode != "update":
        return symbols.withColumn("start_date", F.lit(start or history_start))
    required_table(spark, bars_directory, "historical", "daily-bar history")
    last = bar_state(spark, bars_directory, "historical").first()["max_date"]
    if last is None:
        raise ValueError("historical metadata has no max_date")
    pending = _pending(spark, directory, _applied(spark, bars_directory))
    return B.update_plan(symbols, last, pending.filter("symbol is not null"), start, overlap_days, history_start)


_EVENT = "provider_event_id string"


def _applied(spark: SparkSession, bars_directory: str) -> DataFrame:
    """The ledger of applied splits (provider_event_id)."""
    found = is_published(spark, bars_directory, "applied_splits")
    return published(spark, bars_directory, "applied_splits") if found else spark.createDataFrame([], _EVENT)


def _pending(spark: SparkSession, directory: str, applied: DataFrame) -> DataFrame:
    """(provider_event_id, symbol): splits to read again that are not applied."""
    if not is_published(spark, directory, "split_refresh"):
        return spark.createDataFrame([], f"{_EVENT}, symbol string")
    return B.pending_splits(published(spark, directory, "split_refresh"), applied, published(spark, directory, "corporate_actions"))


def run_daily_bars(spark: SparkSession, mode: str, raw_pages: str, split_pages: str, directory: str, bars_directory: str, snapshot: dt.date, overlap_days: int = B.OVERLAP_DAYS, start: dt.date | None = None, history_start: dt.date = S.HISTORY_START, end: dt.date | None = None) -> dict[str, str]:
    """Publish bars and their quarantine from landed raw and split-adjusted pages; an update replaces planned ranges.

    end: the last day asked for, by default the last weekday before the snapshot; a given one also bounds the bars.
    """
    require_at_least(overlap_days, 1, "overlap_days")
    plan = plan_daily_bars(spark, mode, directory, bars_directory, overlap_days, start, history_start).persist()
    if plan.isEmpty():
        raise ValueError("no symbols to read")
    tickers = published(spark, directory, "tickers")
    sides = [B.one_bar_per_day(P.bar_rows(P.landed_pages(spark, path), side)) for path, side in ((raw_pages, "raw"), (split_pages, "split_adjusted"))]
    since = plan.select(F.col("symbol").alias("__s"), "start_date")
    pairs = B.paired(*sides).join(since, F.col("symbol") == F.col("__s"), "left").filter("start_date is null or date >= start_date").drop("__s", "start_date")
    if end is not None:
        pairs = pairs.filter(F.col("date") <= F.lit(end))
    bars = B.as_bars(B.mapped_bars(pairs, tickers, plan, history_start), snapshot).persist()
    good, bad = B.safe(bars), B.quarantined(bars)
    touched: dict[str, list[str]] = {}
    if mode == "update":
        good, bad = (_replaced_parts(spark, bars_directory, name, dataset, fresh, plan, touched) for name, dataset, fresh in (("historical", HISTORICAL, good), ("identity_quarantine", QUARANTINE, bad)))
    asked = _row(plan.agg(F.min("start_date").alias("d"), F.count(F.lit(1)).alias("n")))
    base = {"snapshot_date": snapshot.isoformat()}
    extra = base | {"requested_start_date": asked["d"].isoformat(), "requested_end_date": (end or latest_session(spark, snapshot)).isoformat(), "input_symbol_count": asked["n"]}
    tables = {}
    if mode == "pilot":
        names = ("pilot", "pilot_identity_quarantine")
        extra |= _row(B.mapped_gate(bars))
    else:
        names = ("historical", "identity_quarantine")
        known = _applied(spark, bars_directory)
        actions = published(spark, directory, "corporate_actions") if is_published(spark, directory, "corporate_actions") else None
        done = known if actions is None else B.applied_after(mode, known, _pending(spark, directory, known), actions)
        states = {name: _states(spark, bars_directory, name, dataset, rows, touched).persist() for name, dataset, rows in ((names[0], HISTORICAL, good), (names[1], QUARANTINE, bad))}
        tables |= {f"{name}_state": (rows, BAR_STATE, base) for name, rows in states.items()} | {"applied_splits": (done, APPLIED_SPLITS, base)}
        extra |= _row(B.state_metrics(states[names[0]])) | {"applied_split_event_count": done.count()}
    try:
        second = base | (_row(B.bar_metrics(bad)) if mode == "pilot" else _row(B.state_metrics(states[names[1]])))
        return publish({names[0]: (good, HISTORICAL, extra), names[1]: (bad, QUARANTINE, second)} | tables, bars_directory, touched)
    finally:
        bars.unpersist()
        plan.unpersist()


def _replaced_parts(spark: SparkSession, directory: str, name: str, dataset: Dataset, fresh: DataFrame, plan: DataFrame, touched: dict[str, list[str]]) -> DataFrame:
    """The new rows of the parts that planned ranges or fresh rows touch; the parts' names go into touched."""
    known = list(current(spark, directory)["tables"].get(name, {"parts": {}})["parts"])
    here = {r[0] for r in fresh.select(part_of(dataset, F.col(dataset.date), F.col(dataset.sort[0]))).distinct().collect()}  # a row a part
    planned = touched_parts(plan, dataset, "symbol", "start_date", known) if known else []
    touched[name] = sorted(here | set(planned))
    return B.replaced(published(spark, directory, name, parts=touched[name]), fresh, plan)


def _states(spark: SparkSession, directory: str, name: str, dataset: Dataset, rows: DataFrame, touched: dict[str, list[str]]) -> DataFrame:
    """The symbols' states of a whole bar table: new ones of the given rows, those of the parts that stay as they are."""
    fresh = B.symbol_state(rows, part_of(dataset, F.col(dataset.date), F.col(dataset.sort[0])))
    if name not in touched or not is_published(spark, directory, f"{name}_state"):
        return fresh
    return published(spark, directory, f"{name}_state").filter(~F.col("part").isin(touched[name])).unionByName(fresh)


def latest_session(spark: SparkSession, snapshot: dt.date) -> dt.date:
    """The last weekday before the snapshot."""
    from ..functions.scalars import latest_session as expr

    return spark.range(1).select(expr(F.lit(snapshot)).alias("d")).first()["d"]


def run_coverage_audit(spark: SparkSession, pages: str, directory: str, snapshot: dt.date, history_start: dt.date = S.HISTORY_START) -> dict[str, str]:
    """Publish the coverage audit of the sampled securities from landed audit envelopes; the metadata holds the gate."""
    master = required_table(spark, directory, "security_master", "security master")
    episodes = required_table(spark, directory, "symbol_episodes", "symbol episodes")
    end = latest_session(spark, snapshot)
    sample = U.audit_sample(master, end, require_unique(episodes, ["episode_id"], "symbol episodes"), history_start).persist()
    U.require_all_categories(sample)
    observations, results = P.audit_rows(P.landed_pages(spark, pages))
    report = U.coverage_report(sample, observations, results, snapshot, end, end - dt.timedelta(days=U.COMPARISON_DAYS), history_start).persist()
    extra = _row(U.coverage_summary(report)) | {"snapshot_date": snapshot.isoformat(), "audit_end_date": end.isoformat(), "audit_sample_version": U.VERSION}
    extra |= {"status_counts": {r[0]: r[1] for r in U.status_counts(report).collect()}, "category_counts": {r[0]: r[1] for r in U.category_counts(report).collect()}}
    try:
        return publish({"alpaca_coverage_audit": (report, AUDIT, json.loads(json.dumps(extra, default=str)))}, directory)
    finally:
        report.unpersist()
        sample.unpersist()
