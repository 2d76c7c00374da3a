"""Corporate actions: routing of identity fields, dated identity matching, overlap refresh, changed splits."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X
from ..sources.tables import written
from .validate import require_action_keys, require_at_least

OVERLAP_DAYS = 30
# The fields of a payload that are read, and which of them name the primary and the related side of an event
# (`<side>_symbol`, `<side>_cusip`); types that are not listed use `symbol` and `new_symbol`.
FIELDS = (
    "id", "process_date", "effective_date", "ex_date", "record_date", "payable_date", "symbol", "cusip", "old_symbol", "old_cusip", "new_symbol", "new_cusip",
    "acquiree_symbol", "acquiree_cusip", "acquirer_symbol", "acquirer_cusip", "source_symbol", "source_cusip",
    "rate", "old_rate", "new_rate", "source_rate", "acquiree_rate", "acquirer_rate", "cash_rate", "currency", "sub_type", "special", "foreign",
)
PRIMARY_SIDES = (("acquiree", X.MERGER_TYPES), ("old", ("name_change", "unit_split")), ("source", ("spin_off", "rights_distribution")))
RELATED_SIDES = (("acquirer", X.MERGER_TYPES),)


def _routed(kind: str) -> tuple[Column, Column]:
    """Primary and related `symbol` or `cusip` of a parsed payload by its action type."""
    primary = F.col("__p.symbol") if kind == "symbol" else X.first_true(F.col("__p.cusip"), F.col("__p.old_cusip"))
    related = F.col(f"__p.new_{kind}")
    for side, types in PRIMARY_SIDES:
        primary = F.when(F.col("action_type").isin(*types), F.col(f"__p.{side}_{kind}")).otherwise(primary)
    for side, types in RELATED_SIDES:
        related = F.when(F.col("action_type").isin(*types), F.col(f"__p.{side}_{kind}")).otherwise(related)
    tidy = X.symbol if kind == "symbol" else X.clean
    return tidy(primary), tidy(related)


def parsed_actions(rows: DataFrame) -> DataFrame:
    """Rows (page_no, pos, action_type, raw JSON) with typed fields, event dates and payload hashes. Each payload is parsed once."""
    field = lambda name: F.col(f"__p.{name}")
    primary, related = _routed("symbol")
    cusip, other_cusip = _routed("cusip")
    landed = [c for c in ("page_no", "pos") if c in rows.columns]
    parsed = rows.select(*landed, "action_type", "raw", F.from_json("raw", ", ".join(f"{name} string" for name in FIELDS)).alias("__p"))
    out = parsed.select(
        *landed,
        X.clean(field("id")).alias("provider_event_id"),
        "action_type",
        *[X.utc_date(field(d)).alias(d) for d in ("process_date", "effective_date", "ex_date", "record_date", "payable_date")],
        primary.alias("primary_symbol"),
        related.alias("related_symbol"),
        cusip.alias("primary_cusip"),
        other_cusip.alias("related_cusip"),
        X.clean(X.first_true(field("old_rate"), field("source_rate"), field("acquiree_rate"))).alias("old_rate"),
        X.clean(X.first_true(field("new_rate"), field("acquirer_rate"))).alias("new_rate"),
        *[X.clean(field(c)).alias(c) for c in ("rate", "cash_rate", "currency", "sub_type")],
        *[X.optional_bool(field(c)).alias(c) for c in ("special", "foreign")],
        X.is_split("action_type").alias("requires_split_history_refresh"),
        X.canonical_json("raw").alias("raw_payload_json"),
    )
    return out.withColumns({"event_date": X.event_date("effective_date", "ex_date", "payable_date", "process_date"), "raw_payload_sha256": X.sha256("raw_payload_json")})


def _asked(events: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """The distinct (__symbol, __day) that events ask for, by the names of their (symbol, day) columns."""
    each = F.array(*[F.struct(F.col(s).alias("__symbol"), F.col(d).alias("__day")) for s, d in pairs])
    return events.select(F.inline(each)).filter("__symbol is not null and __symbol <> ''").distinct()


def _identities(asked: DataFrame, episodes: DataFrame) -> DataFrame:
    """(__symbol, __day, __status, __security): the security that carried a symbol on a day, and how sure that is."""
    e = episodes.select(F.upper("symbol").alias("__e_symbol"), "security_id", "symbol_valid_from", "symbol_valid_to", F.coalesce("is_episode_mapping_eligible", F.lit(False)).alias("fine"))
    met = asked.join(e, F.col("__symbol") == F.col("__e_symbol"), "left")
    dated = F.col("__e_symbol").isNotNull() & X.within("__day", "symbol_valid_from", "symbol_valid_to")
    found = met.groupBy("__symbol", "__day").agg(
        F.count("__e_symbol").alias("episodes"),
        F.count_if(dated).alias("dated"),
        F.count_distinct(F.when(dated, F.col("security_id"))).alias("securities"),
        F.max(F.when(dated, F.col("security_id"))).alias("security"),
        F.count_if(dated & ~F.col("fine")).alias("unfit"),
    )
    word = F.when(F.col("episodes") == 0, "unmatched_symbol").when(F.col("dated") == 0, "unmatched_date").when(F.col("securities") != 1, "ambiguous").when(F.col("unfit") > 0, "identity_quarantine").otherwise("matched")
    return found.select("__symbol", "__day", word.alias("__status"), F.when(word == "matched", F.col("security")).alias("__security"))


def _with_identity(events: DataFrame, found: DataFrame, symbol: str, day: str, security: str, status: str) -> DataFrame:
    # an event without a date is matched by null-safe equality, as the days were grouped
    named = found.withColumnsRenamed({"__status": status, "__security": security})
    joined = events.join(named, (F.col(symbol) == F.col("__symbol")) & F.col(day).eqNullSafe(F.col("__day")), "left").drop("__symbol", "__day")
    return joined.withColumn(status, F.coalesce(status, F.lit("not_applicable")))


def matched_identity(events: DataFrame, episodes: DataFrame, symbol: str, day: str, security: str, status: str) -> DataFrame:
    """events plus the security that carried a symbol on a day, and how sure that is.

    Each distinct (symbol, day) is matched once and joined back, so an event never multiplies and a symbol with many
    events costs one match per day.
    """
    return _with_identity(events, _identities(_asked(events, (symbol, day)), episodes), symbol, day, security, status)


def identified_actions(events: DataFrame, episodes: DataFrame, snapshot: dt.date) -> DataFrame:
    """Events, one row an id, with both identities: the primary on its match date, the related on the event date.

    What both sides ask for is looked up together. Only ids, symbols and days are sent to the look-up, and what each id has
    found is written down; whole rows move once, to that.
    """
    dated = events.withColumn("match_date", X.match_date("action_type", "event_date"))
    primary, related = ("primary_symbol", "match_date"), ("related_symbol", "event_date")
    sides = F.array(*[F.struct(F.lit(own).alias("__own"), F.col(s).alias("__asked"), F.col(d).alias("__on")) for own, (s, d) in ((True, primary), (False, related))])
    asked = dated.select("provider_event_id", F.inline(sides)).filter("__asked is not null and __asked <> ''")
    met = _with_identity(asked, _identities(_asked(dated, primary, related), episodes), "__asked", "__on", "__security", "__status")
    names = {"security_id": ("__own", "__security"), "identity_match_status": ("__own", "__status"), "related_security_id": ("not __own", "__security"), "related_identity_match_status": ("not __own", "__status")}
    each = met.groupBy("provider_event_id").agg(*[F.max(F.when(F.expr(side), F.col(c))).alias(name) for name, (side, c) in names.items()])
    out = dated.join(written(each, "action-identities"), "provider_event_id", "left").withColumn("snapshot_date", F.lit(snapshot))
    return out.withColumns({c: F.coalesce(c, F.lit("not_applicable")) for c in ("identity_match_status", "related_identity_match_status")})


def one_per_event(actions: DataFrame, more: dict[str, Column] | None = None) -> DataFrame:
    """Of each event id the last by process date and type; on a tie the one landed last. Repeats combine before they are shuffled.

    The row is one struct that begins with the columns it is compared by, so that none is held twice. more: aggregates over
    all rows of an id, as further columns.
    """
    landed = [c for c in ("page_no", "pos") if c in actions.columns]
    first = ["process_date", "action_type", *landed, "raw_payload_sha256"]
    row = F.max(F.struct(*first, *[c for c in actions.columns if c not in ("provider_event_id", *first)])).alias("row")
    more = more or {}
    found = actions.groupBy("provider_event_id").agg(row, *[c.alias(name) for name, c in more.items()])
    return found.select("provider_event_id", "row.*", *more).select(*actions.columns, *more)


def corporate_actions(rows: DataFrame, episodes: DataFrame, snapshot: dt.date) -> DataFrame:
    """The corporate-action table of landed action rows. Actions without id or process date fail.

    Parsed rows are shuffled by id once, as they stream, and the last of each is written down: checks, look-ups and the
    table itself read columns of those that stay. Hashes follow from payloads, so they are neither shuffled nor written.
    """
    parsed = parsed_actions(rows).drop("raw_payload_sha256").repartition("provider_event_id")
    last = one_per_event(parsed.withColumn("raw_payload_sha256", X.sha256("raw_payload_json")), {"__dated": F.bool_and(F.col("process_date").isNotNull())})
    kept = written(last.drop("page_no", "pos", "raw_payload_sha256"), "actions-kept")
    require_action_keys(kept.withColumn("process_date", F.when(F.col("__dated"), F.col("process_date"))))
    out = identified_actions(kept.drop("__dated"), episodes, snapshot).withColumn("raw_payload_sha256", X.sha256("raw_payload_json"))
    return out.select(*[F.col(f.name).cast(f.dataType) for f in S.ACTIONS.fields])


def refresh_start(existing: DataFrame | None, end: dt.date, overlap_days: int = OVERLAP_DAYS, history_start: dt.date = S.HISTORY_START) -> dt.date:
    """First day to ask for again: the overlap before the last known process date (or end), never before the floor."""
    require_at_least(overlap_days, 1, "overlap_days")
    if existing is None or "process_date" not in existing.columns:
        return history_start
    last = existing.agg(F.max(F.col("process_date").cast("date")).alias("d")).first()["d"]
    return history_start if last is None else max(history_start, min(end, last) - dt.timedelta(days=overlap_days))


def merged(existing: DataFrame | None, refreshed: DataFrame, start: dt.date) -> DataFrame:
    """Known actions before start together with the refreshed ones: whatever was not returned again is gone.

    On a tie of process date and type the refreshed row counts. Running it twice changes nothing.
    """
    fresh = refreshed.withColumn("page_no", F.lit(1))
    if existing is not None:
        fresh = existing.filter(F.col("process_date").cast("date") < F.lit(start)).withColumn("page_no", F.lit(0)).unionByName(fresh, allowMissingColumns=True)
    return one_per_event(fresh).drop("page_no")


def changed_splits(existing: DataFrame | None, refreshed: DataFrame) -> DataFrame:
    """(provider_event_id): refreshed splits that are new or whose payload differs."""
    splits = refreshed.filter("requires_split_history_refresh").select("provider_event_id", F.col("raw_payload_sha256").alias("new_hash"))
    if existing is None:
        return splits.select("provider_event_id").distinct()
    known = existing.filter("provider_event_id is not null and raw_payload_sha256 is not null").select("provider_event_id", F.col("raw_payload_sha256").alias("old_hash"))
    both = splits.join(known, "provider_event_id", "left")
    return both.filter(~F.col("old_hash").eqNullSafe(F.col("new_hash"))).select("provider_event_id").distinct()
