"""Symbol episodes: when each security traded under which symbol.

Name changes are walked backwards from a security's last symbol. A step's outcome depends only on the name change that
was taken (its old symbol is the next cursor, its date the next boundary), so the default step of every such state is found
once, by one sorted pass over states and changes of each symbol; states are numbers, and symbols and dates are looked up for
the walks alone. A security's own steps, into symbols that it holds itself, are break points in this forest. Walks are read
off by pointer doubling: each round doubles the number of steps that every walk knows, so their number grows with the
logarithm of the longest chain.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X
from ..sources.tables import written
from .validate import require_columns


def one_per_event(changes: DataFrame) -> DataFrame:
    """Of each event id the last by date, id and symbols (nulls count as latest); null ids form one group.

    Repeats combine before they are shuffled.
    """
    latest = F.struct(*[x for c in ("process_date", "old_symbol", "new_symbol") for x in (F.col(c).isNull(), F.col(c))])
    row = F.max_by(F.struct(*changes.columns), latest).alias("row")
    return changes.groupBy("event_id").agg(row).select("row.*")


def _states(changes: DataFrame, snapshot: dt.date) -> DataFrame:
    """Changes that may be walked (id, event, old, new, day). The number of a change also names the state after it."""
    known = changes.filter(F.col("process_date") < F.date_add(F.lit(snapshot), 1))
    return known.select(F.monotonically_increasing_id().alias("id"), F.coalesce("event_id", F.lit("")).alias("event"), F.col("old_symbol").alias("old"), F.col("new_symbol").alias("new"), F.col("process_date").alias("day"))


def terminals(master: DataFrame) -> DataFrame:
    """(security_id, terminal, is_single): the only active symbol, else the last by activity, delisting and symbol."""
    latest = F.struct(F.col("active").isNull(), "active", F.col("delisted_date").isNull(), "delisted_date", "symbol")
    return master.groupBy("security_id").agg(F.max_by("symbol", latest).alias("terminal"), (F.count_if("active") == 1).alias("is_single"))


def default_steps(events: DataFrame, roots: DataFrame) -> DataFrame:
    """(node, next): of every state the latest change into its cursor before its boundary, ties by event id and old symbol.

    States are the roots (node, cursor, boundary) and each change's old symbol and day. States and changes of a symbol are
    sorted together by day, a state before the changes of its own day, and each state takes the last change above it.
    """
    none = F.lit(None).cast("string")
    changes = events.select(F.col("new").alias("cursor"), "day", F.lit(1).alias("kind"), "event", "old", F.col("id").alias("node"))
    after = events.select(F.col("old").alias("cursor"), "day", F.lit(0).alias("kind"), none.alias("event"), none.alias("old"), F.col("id").alias("node"))
    first = roots.select("cursor", F.col("boundary").alias("day"), F.lit(0).alias("kind"), none.alias("event"), none.alias("old"), "node")
    order = Window.partitionBy("cursor").orderBy("day", "kind", F.desc("event"), F.desc("old")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    seen = changes.unionByName(after).unionByName(first).withColumn("next", F.last(F.when(F.col("kind") == 1, F.col("node")), ignorenulls=True).over(order))
    return seen.filter("kind = 0 and next is not null").select("node", "next")


def own_steps(events: DataFrame, master: DataFrame) -> DataFrame:
    """(security_id, cursor, p_id, p_day, p_until): the change that a security prefers at a cursor.

    It is the only earlier change into the cursor from a symbol of the same security, and so the first of these; it is
    the only one for boundaries after its own day and up to the day of the next one (p_until; null: whenever later).
    """
    own = master.select("security_id", F.col("symbol").alias("old")).distinct()
    order = Window.partitionBy("security_id", "new").orderBy("day", "event", "old", "id")
    each = events.join(own, "old").withColumns({"n": F.row_number().over(order), "p_until": F.lead("day").over(order)})
    first = each.filter("n = 1 and (p_until is null or p_until > day)")
    return first.select("security_id", F.col("new").alias("cursor"), F.col("id").alias("p_id"), F.col("day").alias("p_day"), "p_until")


def reached(starts: DataFrame, steps: DataFrame, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """(start, node, depth): every node on the way from each start (start, node), with its distance, along steps (node, next).

    Pointer doubling: a round appends as many steps as are known so far, and squares the jumps. The jumps of 1, 2, 4 ...
    steps come with it.
    """
    known = starts.select("start", "node", F.lit(0).alias("depth"))
    jumps, width, levels = steps, 1, [steps]
    while True:
        # both halves of a round in one job: they read the same jumps
        far = jumps.select(F.col("node").alias("at"), F.col("next").alias("then"))
        more = known.join(far, F.col("node") == F.col("at")).select("start", F.col("then").alias("node"), (F.col("depth") + width).alias("depth"), F.lit(None).cast(jumps.schema["next"].dataType).alias("next"))
        wide = jumps.join(far, F.col("next") == F.col("at")).select(F.lit(None).cast(known.schema["start"].dataType).alias("start"), "node", F.lit(None).cast("int").alias("depth"), F.col("then").alias("next"))
        both = written(more.unionByName(wide), f"{name}-round")
        more, jumps = both.filter("depth is not null").drop("next"), both.filter("depth is null").select("node", "next")
        if more.isEmpty():
            return known, levels
        known = known.unionByName(more)
        levels.append(jumps)
        width *= 2


def _all_after(begins: DataFrame, levels: list[DataFrame]) -> DataFrame:
    """(security_id, node): the nodes begins and all behind them, by the jumps that have been squared already."""
    found = begins
    for jumps in levels:
        found = found.join(jumps, "node", "left").select("security_id", F.explode(F.array_compact(F.array("node", "next"))).alias("node"))
    return found.distinct()


def _with_place(nodes: DataFrame, events: DataFrame) -> DataFrame:
    """nodes behind the first ones, with the cursor and the boundary of the state that each names."""
    return nodes.join(events.select(F.col("id").alias("node"), F.col("old").alias("cursor"), F.col("day").alias("boundary")), "node")


def walks(master: DataFrame, changes: DataFrame, snapshot: dt.date) -> tuple[DataFrame, DataFrame]:
    """(start, security_id), and each start's walk (start, step, cursor, old, day), dealt by start.

    Securities with one terminal share a start. Only those whose default walk comes by a step of their own (mostly none)
    have a start each: they are walked again, over the states that they can be in, each with its own next step.
    """
    events = written(_states(changes, snapshot), "walk-events")
    end, last_day = terminals(master).select("security_id", F.col("terminal").alias("cursor")), F.date_add(F.lit(snapshot), 1)
    roots = written(end.select("cursor").distinct().select("cursor", (-1 - F.monotonically_increasing_id()).alias("node"), last_day.alias("boundary")), "walk-roots")
    rooted = end.join(roots.select("cursor", "node"), F.equal_null(end["cursor"], roots["cursor"])).select("security_id", "node")
    default = written(default_steps(events, roots), "walk-default")
    forest, levels = reached(roots.select(F.col("node").alias("start"), "node"), default, "walk")
    first = roots.select(F.col("node").alias("start"), F.lit(0).alias("depth"), "cursor", "boundary")
    nodes = _with_place(forest.filter("depth > 0"), events).select("start", "depth", "cursor", "boundary").unionByName(first)
    # which walks come to a symbol that was renamed from one of the security's own; equal hashes only add walks
    meets = events.select("old", "new").distinct().join(master.select("security_id", F.col("symbol").alias("old")).distinct(), "old").join(rooted, "security_id").select("security_id", F.xxhash64("node", "new").alias("place"))
    breaks = meets.join(nodes.select(F.xxhash64("start", "cursor").alias("place")), "place", "left_semi").select("security_id").distinct()
    breaks = written(breaks.select("security_id", (-(1 << 62) - F.monotonically_increasing_id()).alias("mine")), "walk-breaks")
    if breaks.isEmpty():
        return rooted.withColumnRenamed("node", "start"), _until_seen(nodes)
    own = written(own_steps(events, master.join(breaks, "security_id", "left_semi")), "walk-own")
    turning = rooted.join(breaks, "security_id")
    begins = turning.select("security_id", "node").unionByName(own.select("security_id", F.col("p_id").alias("node"))).distinct()
    may_be = written(_all_after(begins, levels), "walk-may-be")
    placed = _with_place(may_be, events).unionByName(may_be.join(roots, "node"))
    p = own.select(F.col("security_id").alias("p_security"), F.col("cursor").alias("p_cursor"), "p_id", "p_day", "p_until")
    fits = (F.col("security_id") == F.col("p_security")) & (F.col("cursor") == F.col("p_cursor")) & (F.col("p_day") < F.col("boundary")) & (F.col("p_until").isNull() | (F.col("boundary") <= F.col("p_until")))
    of = lambda node: F.struct(F.col("security_id"), F.col(node).alias("node"))
    chosen = placed.join(default, "node").join(p, fits, "left").withColumn("next", F.coalesce("p_id", "next")).select(of("node").alias("node"), of("next").alias("next"))
    turned, _ = reached(turning.select(F.col("mine").alias("start"), of("node").alias("node")), written(chosen, "walk-chosen"), "walk-own")
    turned = _with_place(turned.filter("depth > 0").select("start", F.col("node.node").alias("node"), "depth"), events)
    again = turned.select("start", "depth", "cursor", "boundary").unionByName(turning.join(roots, "node").select(F.col("mine").alias("start"), F.lit(0).alias("depth"), "cursor", "boundary"))
    starts = rooted.join(breaks, "security_id", "left").select(F.coalesce("mine", "node").alias("start"), "security_id")
    return starts, _until_seen(nodes.unionByName(again))


def chains(master: DataFrame, changes: DataFrame, snapshot: dt.date) -> DataFrame:
    """(security_id, step, cursor, old, day): the name changes on each security's way back, step from 1.

    At a cursor symbol the latest change into it before the boundary date is taken, unless exactly one such change
    comes from a symbol of the same security. A walk ends after a change into a symbol seen before or where no change is
    left, however long it is: every step goes back in time.
    """
    starts, steps = walks(master, changes, snapshot)
    return steps.join(starts, "start").select("security_id", "step", "cursor", "old", "day")


def _until_seen(nodes: DataFrame) -> DataFrame:
    """The steps between the states (start, depth, cursor, boundary) of walks, up to the first symbol met again."""
    again = F.row_number().over(Window.partitionBy("start", "cursor").orderBy("depth")) > 1
    walk = Window.partitionBy("start").orderBy("depth")
    # one shuffle: symbols of a start, starts and what is joined to them are all dealt by the start
    seen = nodes.repartition("start").withColumn("again", again).withColumns({"before": F.lag("cursor").over(walk), "met": F.coalesce(F.max("again").over(walk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(False))})
    return seen.filter("depth > 0 and not met").select("start", F.col("depth").alias("step"), F.col("before").alias("cursor"), F.col("cursor").alias("old"), F.col("boundary").alias("day"))


def symbol_episodes(master: DataFrame, changes: DataFrame, snapshot: dt.date, history_start: dt.date = S.HISTORY_START) -> DataFrame:
    """Dated episodes of every symbol of every security. changes: valid name changes, one per event id."""
    require_columns(master, "security_id symbol company_name active delisted_date is_price_coverage_eligible exclusion_reason symbol_identity_conflict share_class_figi composite_figi cik primary_exchange".split(), "security master")
    master = master.withColumn("symbol", X.symbol("symbol")).withColumn("delisted_date", F.col("delisted_date").cast("date"))
    starts, steps = walks(master, changes, snapshot)
    # each step dates the end of its old symbol and the start of its cursor; a symbol met twice keeps its deepest dates
    start = F.struct(F.col("cursor").alias("symbol"), F.col("day").alias("since"), F.lit(None).cast("date").alias("until"))
    stop = F.struct(F.col("old").alias("symbol"), F.lit(None).cast("date").alias("since"), F.date_sub("day", 1).alias("until"))
    bounds = steps.select("start", "step", F.inline(F.array(start, stop)))
    deepest = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("step")))
    dated = bounds.groupBy("start", "symbol").agg(deepest("since").alias("chain_from"), deepest("until").alias("chain_to")).join(starts, "start").drop("start")
    end = terminals(master)
    rows = master.groupBy("security_id", "symbol").agg(
        F.max_by(F.struct("delisted_date", "is_price_coverage_eligible", "exclusion_reason", "symbol_identity_conflict", "composite_figi", "primary_exchange", "company_name", "share_class_figi", "cik"), F.struct("active", "delisted_date")).alias("own")
    )
    # one shuffle by security, for its symbols, its representative and its neighbours
    each = dated.unionByName(rows, allowMissingColumns=True).repartition("security_id")
    frame = each.groupBy("security_id", "symbol").agg(F.max("chain_from").alias("chain_from"), F.max("chain_to").alias("chain_to"), F.first("own", ignorenulls=True).alias("own"))
    representative = rows.withColumnRenamed("symbol", "terminal").withColumnRenamed("own", "rep").join(end, ["security_id", "terminal"])
    frame = frame.join(representative, "security_id")
    current = F.when(F.col("is_single"), F.col("terminal"))
    is_current = F.coalesce(F.col("symbol") == current, F.lit(False))
    known_to = F.coalesce("chain_to", F.when(~is_current & F.col("own.delisted_date").isNotNull(), F.date_sub("own.delisted_date", 1)))
    frame = frame.withColumns({"current_symbol": current, "is_current_symbol": is_current, "known_from": F.col("chain_from"), "known_to": known_to})
    # gaps take the neighbour's known bound
    order = Window.partitionBy("security_id").orderBy(F.col("known_to").asc_nulls_last(), F.col("known_from").asc_nulls_last(), "symbol")
    first = F.row_number().over(order) == 1
    filled_from = F.when(first, F.lit(history_start)).otherwise(F.date_add(F.lag("known_to").over(order), 1))
    next_from = F.lead("known_from").over(order)
    frame = frame.withColumns({"is_first": first, "filled_from": filled_from, "filled_to": F.date_sub(next_from, 1)})
    frame = frame.withColumns(
        {
            "symbol_valid_from": F.coalesce("known_from", "filled_from"),
            "symbol_valid_to": F.coalesce("known_to", "filled_to"),
            "in_chain": F.col("chain_from").isNotNull() | F.col("chain_to").isNotNull(),
        }
    )
    sources = X.tags(
        (((F.col("known_from").isNull() & ~F.col("is_first") & F.col("filled_from").isNotNull()) | (F.col("known_to").isNull() & F.col("filled_to").isNotNull())), "adjacent_episode_inference"),
        (F.col("in_chain"), "alpaca_name_change"),
        (F.col("known_from").isNull() & F.col("is_first"), "history_window_floor"),
        (F.col("own").isNotNull(), "massive_inventory"),
    )
    invalid = F.col("symbol_valid_from").isNull() | F.coalesce(F.col("symbol_valid_from") > F.col("symbol_valid_to"), F.lit(False))
    source = lambda c: F.when(F.col("own").isNotNull(), F.col(f"own.{c}")).otherwise(F.col(f"rep.{c}"))
    eligible = F.coalesce(source("is_price_coverage_eligible"), F.lit(False))
    own = {
        "episode_id": X.episode_id("security_id", "symbol", "symbol_valid_from"),
        "company_name": F.col("rep.company_name"),
        "episode_source": X.joined(sources),
        "episode_status": F.when(invalid, "unresolved").when(F.col("is_current_symbol"), "current").otherwise("bounded"),
        "is_price_coverage_eligible": eligible,
        "is_episode_mapping_eligible": eligible & ~invalid,
        "security_exclusion_reason": source("exclusion_reason"),
        "symbol_identity_conflict": F.coalesce(source("symbol_identity_conflict"), F.lit(False)),
        "share_class_figi": F.col("rep.share_class_figi"),
        "composite_figi": F.col("own.composite_figi"),
        "cik": F.col("rep.cik"),
        "primary_exchange": source("primary_exchange"),
        "snapshot_date": F.lit(snapshot),
    }
    frame = frame.select(*[own.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in S.EPISODES.fields])
    return mark_overlaps(frame)


def _with_best_of_others(rows: DataFrame, value: str, key: Column, out: str) -> DataFrame:
    """rows plus out: the largest `value` of another security among the rows of the symbol up to the same key.

    Two running maxima do it in one sorted pass: the best with its security, and the best of all rows that never had the
    lead or lost it to another security.
    """
    order = Window.partitionBy("symbol").orderBy(key)
    so_far, with_ties = order.rowsBetween(Window.unboundedPreceding, Window.currentRow), order.rangeBetween(Window.unboundedPreceding, Window.currentRow)
    own, mine = F.col("security_id"), F.when(F.col(value).isNotNull() & F.col("security_id").isNotNull(), F.struct(F.col(value).alias("v"), F.col("security_id").alias("s")))
    rows = rows.withColumn("__mine", mine).withColumn("__lead", F.max("__mine").over(so_far))
    rows = rows.withColumn("__lost", F.lag("__lead").over(order))
    beaten = F.when(F.col("__mine").isNotNull(), F.when(F.col("__lead.s") != own, F.col(value)).when(F.col("__lost.s") != own, F.col("__lost.v")))
    rows = rows.withColumn("__beaten", beaten).withColumns({"__first": F.max("__mine").over(with_ties), "__second": F.max("__beaten").over(with_ties)})
    return rows.withColumn(out, F.when(F.col("__first.s") != own, F.col("__first.v")).otherwise(F.col("__second"))).drop("__mine", "__lead", "__lost", "__beaten", "__first", "__second")


def mark_overlaps(episodes: DataFrame) -> DataFrame:
    """Episodes that share a symbol and a day with another security's episode become unresolved and unmappable.

    A sweep over each symbol's days, forwards and backwards: an episode that ends before it starts overlaps those that
    hold all days from its end to its start, any other is held by those that began before it and end on its first day or
    later. What holds it is marked by the backward sweep. An unknown start overlaps every episode of another security.
    """
    day = lambda c: F.unix_date(F.col(c))
    begin, end = day("symbol_valid_from"), F.coalesce(day("symbol_valid_to"), F.lit(2**31 - 1))
    rows = episodes.withColumns({"__begin": begin, "__end": end})
    valid = F.col("__begin") <= F.col("__end")
    rows = rows.withColumns({"__key": F.least("__begin", "__end"), "__hold": F.when(valid, F.col("__end")), "__back": -F.col("__begin")})
    rows = rows.withColumn("__key", F.when(F.col("__begin").isNotNull(), F.col("__key")))
    rows = _with_best_of_others(rows, "__hold", F.col("__key").asc(), "__longest")
    rows = _with_best_of_others(rows, "__back", F.col("__key").desc(), "__nearest")
    everyone = Window.partitionBy("symbol")
    other = lambda c: (F.min(c).over(everyone) != F.col("security_id")) | (F.max(c).over(everyone) != F.col("security_id"))
    unknown = F.when(F.col("__begin").isNull(), F.col("security_id"))
    hit = (F.col("__longest") >= F.col("__begin")) | (valid & (-F.col("__nearest") <= F.col("__end"))) | F.when(F.col("__begin").isNull(), other(F.col("security_id"))).otherwise(other(unknown))
    rows = rows.withColumn("__hit", F.coalesce(F.col("symbol").isNotNull() & F.col("security_id").isNotNull() & hit, F.lit(False)))
    rows = rows.withColumn("__hit", F.max("__hit").over(Window.partitionBy("symbol", "episode_id")))
    own = {
        "episode_status": F.when(F.col("__hit"), "unresolved").otherwise(F.col("episode_status")),
        "is_episode_mapping_eligible": F.col("is_episode_mapping_eligible") & ~F.col("__hit"),
    }
    return rows.select(*[own.get(c, F.col(c)).alias(c) for c in episodes.columns])


def episode_tickers(episodes: DataFrame, master: DataFrame) -> DataFrame:
    """Acquisition manifest with one row per eligible episode; master data of the exact listing, else of the security's last."""
    newest = F.struct("active", "last_updated_utc", "symbol")  # nulls come first, so they lose
    slim = master.select("security_id", "symbol", "active", "last_updated_utc", F.struct("sector", "industry", "alpaca_asset_id", "alpaca_status", "alpaca_tradable", "is_known_reit").alias("m"))
    last = lambda keys, name: slim.groupBy(*keys).agg(F.max_by("m", newest).alias(name))

    frame = episodes.filter("is_price_coverage_eligible").join(last(["security_id", "symbol"], "exact"), ["security_id", "symbol"], "left").join(last(["security_id"], "any"), "security_id", "left")
    from_any = lambda c: F.when(F.col("exact").isNotNull(), F.col(f"exact.{c}")).otherwise(F.col(f"any.{c}"))
    own = {
        "provider_symbol": F.col("symbol"),
        "sector": from_any("sector"),
        "industry": from_any("industry"),
        "active": F.col("is_current_symbol"),
        "delisted_date": F.col("symbol_valid_to"),
        "alpaca_asset_id": F.col("exact.alpaca_asset_id"),
        "alpaca_status": F.col("exact.alpaca_status"),
        "alpaca_tradable": F.col("exact.alpaca_tradable"),
        "is_known_reit": F.coalesce(from_any("is_known_reit"), F.lit(False)),
    }
    return frame.select(*[own.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in S.TICKERS.fields])
