"""Daily bars: raw and split-adjusted bars side by side, mapped to securities by dated symbols."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X

OVERLAP_DAYS = 7
DIFFERENCE = 1e-9
# The symbols of a pilot run, in order.
PILOT_SYMBOLS = ("AAPL", "NVDA", "GE", "AMC", "SYMC", "NLOK", "GEN", "FB", "META", "TWTR", "VAPO", "MBGLW")


def one_bar_per_day(bars: DataFrame) -> DataFrame:
    """Of each (symbol, date) the bar landed last (by page_no, pos). Repeats combine before they are shuffled."""
    measures = [c for c in bars.columns if c not in ("symbol", "date", "page_no", "pos")]
    row = F.max_by(F.struct(*measures), F.struct("page_no", "pos")).alias("row")
    return bars.groupBy("symbol", "date").agg(row).select("symbol", "date", "row.*")


def paired(raw: DataFrame, split: DataFrame) -> DataFrame:
    """Both sides of every (symbol, date), and `pair`: both, raw_only or split_only. One bar per key on each side."""
    a, b = raw.withColumn("__a", F.lit(True)), split.withColumn("__b", F.lit(True))
    both = a.join(b, ["symbol", "date"], "full_outer")
    pair = F.when(F.col("__a") & F.col("__b"), "both").when(F.col("__a"), "raw_only").otherwise("split_only")
    return both.withColumn("pair", pair).drop("__a", "__b")


def mapped_bars(pairs: DataFrame, episodes: DataFrame, requested: DataFrame | None = None, history_start: dt.date = S.HISTORY_START) -> DataFrame:
    """pairs plus security_id, episode_id, current_symbol and identity_status.

    episodes: security_id, episode_id, current_symbol, symbol (or provider_symbol), bounds, is_episode_mapping_eligible.
    Bars join their symbol's episodes as one array per symbol, so the interval match is a filter inside the row: no bar
    multiplies, nothing is grouped back, and a hot symbol can be split by Spark like any join key. A symbol has few
    episodes, so its array is small.
    """
    name = F.upper(F.col("provider_symbol") if "provider_symbol" in episodes.columns else F.col("symbol"))
    current = F.col("current_symbol") if "current_symbol" in episodes.columns else F.lit(None).cast("string")
    own = episodes.select(name.alias("symbol"), F.struct(F.coalesce("symbol_valid_from", F.lit(history_start)).alias("since"), F.col("symbol_valid_to").alias("until"), "security_id", "episode_id", current.alias("current_symbol"), F.coalesce("is_episode_mapping_eligible", F.lit(False)).alias("fine")).alias("e"))
    own = own.filter("symbol is not null").groupBy("symbol").agg(F.array_sort(F.collect_list("e")).alias("__episodes"))
    frame = pairs.join(own, "symbol", "left")
    if requested is not None:
        asked = requested.select(F.col("symbol"), F.lit(True).alias("__asked")).distinct()
        frame = frame.join(asked, "symbol", "left").withColumn("__asked", F.coalesce("__asked", F.lit(False)))
    else:
        frame = frame.withColumn("__asked", F.lit(True))
    fits = lambda e: (F.col("date") >= e["since"]) & (e["until"].isNull() | (F.col("date") <= e["until"]))
    frame = frame.withColumn("__hits", F.when(F.col("__asked"), F.filter("__episodes", fits)))
    hits = F.coalesce(F.size("__hits"), F.lit(0))
    frame = frame.withColumn("__n", F.when(F.col("__hits").isNull(), 0).otherwise(hits)).withColumn("__e", F.when(F.col("__n") == 1, F.get("__hits", F.lit(0))))
    status = (
        F.when(F.col("pair") != "both", "missing_adjustment_pair")
        .when(F.col("__n") > 1, "ambiguous_episode_overlap")
        .when((F.col("__n") == 1) & F.col("__e.fine"), "mapped")
        .when(F.col("__n") == 1, "identity_quarantine")
        .when(~F.col("__asked"), "unexpected_returned_symbol")
        .otherwise("outside_symbol_episode")
    )
    out = frame.withColumn("identity_status", status)
    for c in ("security_id", "episode_id", "current_symbol"):
        out = out.withColumn(c, F.col(f"__e.{c}"))
    return out.drop("__episodes", "__asked", "__hits", "__n", "__e", "pair")


def as_bars(mapped: DataFrame, snapshot: dt.date, feed: str = "sip") -> DataFrame:
    """mapped in the published column order and types; measures that are missing are null."""
    full = mapped.withColumns({"source_feed": F.lit(feed), "snapshot_date": F.lit(snapshot)})
    return full.select(*[(F.col(f.name) if f.name in full.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.BARS.fields])


def safe(bars: DataFrame) -> DataFrame:
    return bars.filter("identity_status = 'mapped'")


def quarantined(bars: DataFrame) -> DataFrame:
    return bars.filter("identity_status <> 'mapped'")


def pilot_symbols(tickers: DataFrame, wanted: tuple[str, ...] = PILOT_SYMBOLS) -> DataFrame:
    """(symbol, place): the wanted symbols that the manifest has, in their order."""
    place = F.array_position(F.array(*[F.lit(s) for s in wanted]), F.upper("provider_symbol"))
    return tickers.filter(F.upper("provider_symbol").isin(*wanted)).select(F.upper("provider_symbol").alias("symbol"), place.cast("int").alias("place")).distinct()


def _measured(bars: DataFrame, counted: Column, others: dict[str, Column]) -> DataFrame:
    """One row of the measures of the counted bars and of sums over all bars, from one pass over them.

    Bars are counted by key first and then by symbol, so that what is left are sums over symbols and the distinct names in
    their small sets of securities.
    """
    differs = F.abs(F.col("raw_close") - F.col("split_adjusted_close")) > DIFFERENCE
    per_key = bars.groupBy("symbol", "date").agg(
        F.count_if(counted).alias("n"),
        F.count_if(counted & (F.col("raw_close").isNull() | F.col("split_adjusted_close").isNull())).alias("missing"),
        F.count_if(counted & differs).alias("differing"),
        F.collect_set(F.when(counted, F.col("security_id"))).alias("securities"),
        *[F.count_if(c).alias(name) for name, c in others.items()],
    )
    here = F.col("n") > 0
    per_symbol = per_key.groupBy("symbol").agg(
        F.sum("n").alias("n"),
        F.sum(F.when(F.col("n") > 1, F.col("n"))).alias("repeated"),
        F.sum("missing").alias("missing"),
        F.sum("differing").alias("differing"),
        F.min(F.when(here, F.col("date"))).alias("first"),
        F.max(F.when(here, F.col("date"))).alias("last"),
        F.array_distinct(F.flatten(F.collect_set("securities"))).alias("securities"),
        *[F.sum(name).alias(name) for name in others],
    )
    each = per_symbol.select("*", F.posexplode_outer("securities").alias("at", "security_id"))
    own = F.coalesce(F.col("at"), F.lit(0)) == 0  # a symbol counts once, with its first security
    total = lambda c, name: F.coalesce(F.sum(F.when(own, F.col(c))), F.lit(0)).alias(name)
    return each.agg(
        total("n", "row_count"),
        F.count(F.when(own & here, F.col("symbol"))).alias("symbol_count"),
        F.min("first").cast("string").alias("min_date"),
        F.max("last").cast("string").alias("max_date"),
        total("repeated", "duplicate_key_count"),
        total("missing", "missing_adjustment_pair_count"),
        total("differing", "split_adjustment_difference_count"),
        F.count_distinct("security_id").alias("security_id_count"),
        *[total(name, name) for name in others],
    )


def bar_metrics(bars: DataFrame) -> DataFrame:
    """One row: rows, symbols, securities, date range, rows with repeated keys, missing sides, differing closes.

    Duplicates are counted over the whole table.
    """
    return _measured(bars, F.lit(True), {})


def symbol_state(bars: DataFrame, part: Column) -> DataFrame:
    """One row for each part and symbol: all that `state_metrics` needs of its bars.

    A key lies in one part, so states of parts add up: an update makes new ones for the parts it rewrites and keeps the
    others, and no history is read again.
    """
    # one shuffle for keys, and for the symbols of a part; a key's rows are numbered where they lie
    key = Window.partitionBy("part", "symbol", "date")
    rows = bars.select(part.alias("part"), "symbol", "date", "raw_close", "split_adjusted_close", "security_id").repartition("part", "symbol")
    return rows.withColumn("n", F.count(F.lit(1)).over(key)).groupBy("part", "symbol").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("n") > 1).alias("repeated"),
        F.count_if(F.col("raw_close").isNull() | F.col("split_adjusted_close").isNull()).alias("missing"),
        F.count_if(F.abs(F.col("raw_close") - F.col("split_adjusted_close")) > DIFFERENCE).alias("differing"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
        F.array_sort(F.collect_set("security_id")).alias("securities"),
    )


def state_metrics(state: DataFrame) -> DataFrame:
    """bar_metrics from the symbols' states."""
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).alias(name)
    sums = state.agg(
        total("rows", "row_count"),
        F.count_distinct("symbol").alias("symbol_count"),
        F.min("first_date").cast("string").alias("min_date"),
        F.max("last_date").cast("string").alias("max_date"),
        total("repeated", "duplicate_key_count"),
        total("missing", "missing_adjustment_pair_count"),
        total("differing", "split_adjustment_difference_count"),
    )
    names = state.select(F.explode("securities").alias("s")).agg(F.count_distinct("s").alias("security_id_count"))
    return sums.crossJoin(F.broadcast(names))  # one row each


_PASSED = "row_count > 0 and duplicate_key_count = 0 and missing_adjustment_pair_count = 0 and split_adjustment_difference_count > 0 and quarantine_row_count > 0"


def pilot_gate(bars: DataFrame, quarantine: DataFrame) -> DataFrame:
    """One row of both tables' counts, and whether the pilot passed."""
    q = quarantine.agg(F.count(F.lit(1)).alias("quarantine_row_count"))
    return bar_metrics(bars).crossJoin(F.broadcast(q)).withColumn("pilot_passed", F.expr(_PASSED))  # one row each


def mapped_gate(mapped: DataFrame) -> DataFrame:
    """pilot_gate of mapped bars that are not yet split into safe and quarantined ones: they are read once."""
    fine = F.col("identity_status") == "mapped"
    return _measured(mapped, fine, {"quarantine_row_count": ~fine}).withColumn("pilot_passed", F.expr(_PASSED))


def update_plan(symbols: DataFrame, previous_max: dt.date, pending_symbols: DataFrame, start: dt.date | None = None, overlap_days: int = OVERLAP_DAYS, history_start: dt.date = S.HISTORY_START) -> DataFrame:
    """(symbol, start_date): symbols with pending splits from the floor, the others from the overlap before the last date."""
    usual = start or max(history_start, previous_max - dt.timedelta(days=overlap_days))
    pending = pending_symbols.select(F.upper("symbol").alias("symbol")).distinct().withColumn("__split", F.lit(True))
    plan = symbols.select("symbol").distinct().join(pending, "symbol", "left")
    return plan.select("symbol", F.when(F.col("__split"), F.lit(history_start)).otherwise(F.lit(usual)).alias("start_date"))


def batches(symbols: DataFrame, size: int) -> DataFrame:
    """(symbol, batch_no): symbols in order, `size` to a batch, ranked over range partitions without one sorting task."""
    parts = symbols.select("symbol").distinct().repartitionByRange("symbol").withColumn("part", F.spark_partition_id())
    counts = parts.groupBy("part").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))  # one row per partition
    place = F.row_number().over(Window.partitionBy("part").orderBy("symbol"))
    ranked = parts.withColumn("n", place).join(F.broadcast(before), "part")
    return ranked.select("symbol", F.floor((F.col("before") + F.col("n") - 1) / size).alias("batch_no"))


def replaced(existing: DataFrame, fresh: DataFrame, plan: DataFrame) -> DataFrame:
    """existing without each planned symbol's rows from its start date on, and the fresh rows."""
    p = plan.select(F.col("symbol").alias("__symbol"), "start_date")
    kept = existing.join(p, (F.col("symbol") == F.col("__symbol")) & (F.col("date") >= F.col("start_date")), "left_anti")
    return kept.unionByName(fresh)


def pending_splits(refresh_ids: DataFrame, applied_ids: DataFrame, actions: DataFrame) -> DataFrame:
    """(provider_event_id, symbol): splits to refresh that were not applied; symbol is null where the action has none."""
    pending = refresh_ids.select("provider_event_id").distinct().join(applied_ids.select("provider_event_id"), "provider_event_id", "left_anti")
    return pending.join(actions.select("provider_event_id", F.upper("primary_symbol").alias("symbol")).distinct(), "provider_event_id", "left")


def all_split_ids(actions: DataFrame) -> DataFrame:
    return actions.filter("requires_split_history_refresh and provider_event_id is not null").select("provider_event_id").distinct()


def applied_after(mode: str, applied_ids: DataFrame, pending: DataFrame, actions: DataFrame) -> DataFrame:
    """The ledger of applied splits after a run: a backfill applies all, an update those that were pending."""
    if mode == "backfill":
        return all_split_ids(actions)
    return applied_ids.select("provider_event_id").unionByName(pending.select("provider_event_id")).distinct()
