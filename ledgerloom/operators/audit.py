"""Coverage audit: a reproducible sample of securities, its observed bars, and a proceed-or-blocked gate."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X
from .validate import require_columns, require_values

VERSION = "v1"
RECENT, OLDER, REUSED = 4, 4, 10
RECENT_DAYS = 3 * 366
TOLERANCE_DAYS, STALE_DAYS, COMPARISON_DAYS = 14, 7, 90
COMPARISON_SYMBOLS = ("AAPL", "GE", "NVDA")
CATEGORIES = ("active", "recent_delisting", "older_delisting", "acquisition", "ticker_change", "ticker_reuse", "forward_split", "reverse_split")


# Well-known cases that every audit looks at (symbol, categories, roles, event type, event date).
CASES = (
    ("AAPL", ["active", "forward_split"], ["full_window", "event_both_sides"], "forward_split", dt.date(2020, 8, 31)),
    ("NVDA", ["active", "forward_split"], ["full_window", "event_both_sides"], "forward_split", dt.date(2024, 6, 10)),
    ("GE", ["active", "reverse_split"], ["full_window", "event_both_sides"], "reverse_split", dt.date(2021, 8, 2)),
    ("AMC", ["active", "reverse_split"], ["full_window", "event_both_sides"], "reverse_split", dt.date(2023, 8, 24)),
    ("TWTR", ["acquisition"], ["expected_end"], "acquisition", None),
    ("ATVI", ["acquisition"], ["expected_end"], "acquisition", None),
    ("CERN", ["acquisition"], ["expected_end"], "acquisition", None),
    ("WORK", ["acquisition"], ["expected_end"], "acquisition", None),
)
# Renames (old, new).
RENAMES = (("CTL", "LUMN"), ("SYMC", "GEN"))

_CASE = "symbol string, categories array<string>, roles array<string>, event_type string, event_date date, place int"
_FACTS = "company_name active delisted_date has_alpaca_asset symbol_identity_conflict".split()


def sampled(rows: DataFrame, category: str, count: int) -> DataFrame:
    """The count rows with the smallest hashes of version, category and identity: the same in any input order."""
    rank = F.sha2(F.concat_ws("|", F.lit(VERSION), F.lit(category), "security_id", "symbol"), 256)
    return rows.orderBy(rank, "security_id", "symbol").limit(count)


def audit_sample(master: DataFrame, end: dt.date, episodes: DataFrame | None = None, history_start: dt.date = S.HISTORY_START, cases: tuple[tuple, ...] = CASES, renames: tuple[tuple[str, str], ...] = RENAMES) -> DataFrame:
    """One row per (security, symbol) of the sample: what is known of it, its categories and the roles it is checked in."""
    require_columns(master, ["security_id", "symbol", *_FACTS, "is_price_coverage_eligible"], "security master")
    spark = master.sparkSession
    master = master.select("security_id", "symbol", *[F.col(c).cast("date").alias(c) if c == "delisted_date" else F.col(c) for c in _FACTS], "is_price_coverage_eligible")
    words = lambda *w: F.array(*[F.lit(x) for x in w]).cast("array<string>")

    def entries(rows: DataFrame, order: int, categories: Column, roles: Column, event_type: Column, event_date: Column, place: Column | None = None) -> DataFrame:
        return rows.select("security_id", "symbol", *_FACTS, categories.alias("categories"), roles.alias("roles"), event_type.cast("string").alias("event_type"), event_date.cast("date").alias("event_date"), F.struct(F.lit(order).alias("kind"), (F.lit(0) if place is None else place).cast("int").alias("place"), "security_id", "symbol").alias("ordinal"))

    known = spark.createDataFrame([(*case, i) for i, case in enumerate(cases)], _CASE)
    met = master.join(F.broadcast(known), "symbol")
    parts = [entries(met, 0, F.col("categories"), F.col("roles"), F.col("event_type"), F.coalesce("event_date", "delisted_date"), F.col("place"))]
    pairs = spark.createDataFrame([(a, b, i) for i, (a, b) in enumerate(renames)], "symbol string, new string, place int")
    olds = master.join(F.broadcast(pairs), "symbol")
    change = (words("ticker_change"), F.lit("ticker_change"))
    parts.append(entries(olds, 1, change[0], words("expected_end"), change[1], F.col("delisted_date"), F.col("place") * 2))
    links = olds.select(F.col("security_id").alias("__sec"), F.col("new").alias("__new"), F.col("delisted_date").alias("__day"), "place")
    news = master.join(F.broadcast(links), (F.col("symbol") == F.col("__new")) & (F.col("security_id") == F.col("__sec")))
    parts.append(entries(news, 1, change[0], words("expected_start"), change[1], F.col("__day"), F.col("place") * 2 + 1))
    gone = master.filter("not active and is_price_coverage_eligible and not symbol_identity_conflict and delisted_date is not null")
    border = F.lit(end - dt.timedelta(days=RECENT_DAYS))
    recent, older = gone.filter(F.col("delisted_date") >= border), gone.filter((F.col("delisted_date") >= F.lit(history_start)) & (F.col("delisted_date") < border))
    none = F.lit(None)
    for order, name, rows, count in ((2, "recent_delisting", recent, RECENT), (3, "older_delisting", older, OLDER)):
        parts.append(entries(sampled(rows, name, count), order, words(name), words("expected_end"), none, F.col("delisted_date")))
    parts.append(entries(sampled(master.filter("symbol_identity_conflict"), "ticker_reuse", REUSED), 4, words("ticker_reuse"), words("ambiguous"), none, none))
    every = parts[0]
    for p in parts[1:]:
        every = every.unionByName(p)
    if episodes is not None:
        changed = every.filter(F.array_contains("categories", "ticker_change")).select("security_id").distinct()
        own = episodes.select("security_id", "symbol", F.col("symbol_valid_from").cast("date").alias("symbol_valid_from"), F.col("symbol_valid_to").cast("date").alias("symbol_valid_to"), "is_current_symbol").join(F.broadcast(changed), "security_id", "left_semi")
        have = every.select("security_id", "symbol").distinct().withColumn("__have", F.lit(True))
        own = own.join(have, ["security_id", "symbol"], "left")
        representative = master.groupBy("security_id").agg(F.max_by(F.struct("company_name", "has_alpaca_asset", "symbol_identity_conflict"), "symbol").alias("r"))
        rows = own.join(representative, "security_id").withColumns({"company_name": F.col("r.company_name"), "has_alpaca_asset": F.col("r.has_alpaca_asset"), "symbol_identity_conflict": F.col("r.symbol_identity_conflict"), "active": F.col("is_current_symbol"), "delisted_date": F.col("symbol_valid_to")})
        roles = X.tags((F.col("symbol_valid_from") > F.lit(history_start), "expected_start"), (F.col("symbol_valid_to").isNotNull(), "expected_end"))
        new = F.col("__have").isNull()
        every = every.unionByName(entries(rows, 5, F.when(new, words("ticker_change")).otherwise(words()), roles, F.when(new, F.lit("ticker_change")), none))
    facts = F.min_by(F.struct(*_FACTS), "ordinal").alias("f")
    merged = every.groupBy("security_id", "symbol").agg(
        facts,
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("categories")))), ";").alias("sample_categories"),
        F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_list("roles")))), ";").alias("sample_roles"),
        F.min_by("event_type", F.when(F.col("event_type").isNotNull(), F.col("ordinal"))).alias("known_event_type"),
        F.min_by("event_date", F.when(F.col("event_date").isNotNull(), F.col("ordinal"))).alias("known_event_date"),
    )
    if episodes is not None:
        bounds = episodes.groupBy("security_id", "symbol").agg(F.min_by(F.struct("symbol_valid_from", "symbol_valid_to"), "symbol_valid_from").alias("b"))
        merged = merged.join(bounds, ["security_id", "symbol"], "left").withColumns({"symbol_valid_from": F.col("b.symbol_valid_from"), "symbol_valid_to": F.col("b.symbol_valid_to")})
    else:
        merged = merged.withColumns({"symbol_valid_from": none, "symbol_valid_to": none})
    own = {"sample_id": F.concat_ws("|", "security_id", "symbol")} | {c: F.col(f"f.{c}") for c in _FACTS}
    return merged.select(*[own.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in S.AUDIT_SAMPLE.fields])


def require_all_categories(sample: DataFrame) -> None:
    require_values(sample, "sample_categories", CATEGORIES, "audit sample")


def _assessment(end: dt.date, history_start: dt.date, comparison: tuple[str, ...]) -> tuple[Column, Column]:
    """Reasons (array) and status of a report row."""
    roles = F.split("sample_roles", ";")
    role = lambda name: F.array_contains(roles, name)
    bars = F.col("bar_count") > 0
    after = lambda c, days: F.date_add(c, days)
    expected_end = F.coalesce("symbol_valid_to", F.date_sub("known_event_date", 1))
    expected_start = F.coalesce("symbol_valid_from", "known_event_date")
    compared = F.col("symbol").isin(*comparison)
    failures = X.tags(
        (F.col("request_error").isNotNull() & (F.col("request_error") != ""), "request_error"),
        ((F.size("returned") > 0) & (F.col("returned") != F.array("symbol")), "returned_under_different_symbol"),
        (~bars, "no_bars"),
        (role("ambiguous"), "ambiguous_reused_symbol"),
        (bars & role("full_window") & (F.col("first_bar_date") > after(F.lit(history_start), TOLERANCE_DAYS)), "truncated_start"),
        (bars & F.col("active") & (F.col("last_bar_date") < F.lit(end - dt.timedelta(days=STALE_DAYS))), "active_history_stale"),
        (bars & role("expected_end") & (F.col("last_bar_date") < F.date_sub(expected_end, TOLERANCE_DAYS)), "truncated_end"),
        (bars & role("expected_start") & (F.col("first_bar_date") > after(expected_start, TOLERANCE_DAYS)), "truncated_start"),
        (bars & role("event_both_sides") & (F.col("pre_event_bar_count") == 0), "missing_pre_event_bars"),
        (bars & role("event_both_sides") & (F.col("post_event_bar_count") == 0), "missing_post_event_bars"),
        (compared & (F.col("iex_bars") == 0), "iex_no_bars"),
    )
    warnings = X.tags(
        (F.col("out_of_episode_bar_count") > 0, "bars_outside_episode"),
        (bars & role("expected_end") & (F.col("last_bar_date") > after(expected_end, TOLERANCE_DAYS)), "bars_after_expected_end"),
        (compared & (F.col("iex_bars") > 0) & (F.col("ratio").isNull() | (F.col("ratio") <= 1)), "sip_volume_not_greater_than_iex"),
    )
    status = F.when(F.size(failures) > 0, "fail").when(F.size(warnings) > 0, "warning").otherwise("pass")
    return F.array_distinct(F.concat(failures, warnings)), status


def coverage_report(sample: DataFrame, observations: DataFrame, results: DataFrame, snapshot: dt.date, end: dt.date, comparison_start: dt.date, history_start: dt.date = S.HISTORY_START, comparison: tuple[str, ...] = COMPARISON_SYMBOLS) -> DataFrame:
    """The audit table. observations: feed, requested, returned, date, volume; results: feed, requested, returned_symbols, request_error.

    Observations are summed per symbol and day first, so a sample row meets at most one row a day.
    """
    exact = observations.filter("requested = returned").groupBy("feed", F.col("requested").alias("symbol"), "date").agg(F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("bars"))
    sip = exact.filter("feed = 'sip'").select("symbol", "date", "volume", "bars")
    iex = exact.filter("feed = 'iex'").groupBy("symbol").agg(F.sum("volume").alias("iex_volume"), F.sum("bars").alias("iex_bars"))
    met = sample.select("sample_id", "symbol", "symbol_valid_from", "symbol_valid_to", "known_event_date").join(sip, "symbol")
    inside = X.within("date", "symbol_valid_from", "symbol_valid_to")
    summed = lambda condition, what: F.coalesce(F.sum(F.when(condition, F.col(what))), F.lit(0))
    seen = met.groupBy("sample_id").agg(
        F.sum("bars").alias("raw_bar_count"),
        summed(inside, "bars").alias("bar_count"),
        F.min(F.when(inside, F.col("date"))).alias("first_bar_date"),
        F.max(F.when(inside, F.col("date"))).alias("last_bar_date"),
        summed(inside, "volume").alias("total_volume"),
        summed(inside & (F.col("date") < F.col("known_event_date")), "bars").alias("pre"),
        summed(inside & (F.col("date") >= F.col("known_event_date")), "bars").alias("post"),
        summed(inside & (F.col("date") >= F.lit(comparison_start)), "volume").alias("sip_volume"),
    )
    asked = results.filter("feed = 'sip'").select(F.col("requested").alias("symbol"), F.col("returned_symbols").alias("returned"), F.col("request_error").alias("error"), F.lit(True).alias("__asked"))
    frame = sample.join(seen, "sample_id", "left").join(asked, "symbol", "left").join(iex, "symbol", "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    frame = frame.withColumns({c: zero(c) for c in ("raw_bar_count", "bar_count", "total_volume", "sip_volume", "iex_volume", "iex_bars")})
    compared = F.col("symbol").isin(*comparison)
    only = lambda c: F.when(compared, c)
    frame = frame.withColumns(
        {
            "returned": F.coalesce("returned", F.array().cast("array<string>")),
            "request_error": F.when(F.col("__asked").isNull(), "missing audit result").otherwise(F.col("error")),
            "out_of_episode_bar_count": F.col("raw_bar_count") - F.col("bar_count"),
            "pre_event_bar_count": F.when(F.col("known_event_date").isNotNull(), zero("pre")),
            "post_event_bar_count": F.when(F.col("known_event_date").isNotNull(), zero("post")),
            "ratio": X.ratio("sip_volume", "iex_volume"),
        }
    )
    reasons, status = _assessment(end, history_start, comparison)
    own = {
        "request_start_date": F.lit(history_start),
        "request_end_date": F.lit(end),
        "feed": F.lit("sip"),
        "adjustment": F.lit("raw"),
        "asof": F.lit("-"),
        "returned_symbols": F.array_join("returned", ";"),
        "iex_comparison_start_date": only(F.lit(comparison_start)),
        "iex_bar_count": only(F.col("iex_bars")),
        "iex_total_volume": only(F.col("iex_volume")),
        "sip_comparison_volume": only(F.col("sip_volume")),
        "sip_to_iex_volume_ratio": only(F.col("ratio")),
        "audit_status": status,
        "coverage_reason": X.joined(reasons),
        "snapshot_date": F.lit(snapshot),
    }
    return frame.select(*[own.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name) for f in S.AUDIT.fields])


def coverage_summary(report: DataFrame) -> DataFrame:
    """One row: delisted coverage, feed checks, and whether a backfill may proceed."""
    reasons = F.split(F.coalesce("coverage_reason", F.lit("")), ";")
    has = lambda tag: F.array_contains(reasons, tag)
    delisted = F.contains("sample_roles", F.lit("expected_end")) & ~F.contains("sample_roles", F.lit("ambiguous"))
    covered = delisted & (F.col("bar_count") > 0) & ~(has("no_bars") | has("returned_under_different_symbol") | has("truncated_end"))
    compared = F.col("iex_bar_count").isNotNull()
    change = F.contains("sample_categories", F.lit("ticker_change"))
    adequate = (F.col("bar_count") > 0) & F.col("symbol_valid_from").isNotNull() & X.without("coverage_reason", "bars_outside_episode").isNull()
    every = lambda group, condition: (F.count_if(group) > 0) & (F.count_if(group & ~F.coalesce(condition, F.lit(False))) == 0)
    s = report.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(covered).alias("delisted_coverage_count"),
        F.count_if(delisted).alias("delisted_sample_count"),
        (F.count_if(F.col("bar_count") > 0) > 0).alias("sip_access_verified"),
        every(compared, F.col("sip_to_iex_volume_ratio") > 1).alias("sip_volume_exceeds_iex"),
        (F.count_if(has("returned_under_different_symbol")) > 0).alias("symbol_remapping_observed"),
        every(change, adequate).alias("ticker_change_coverage_adequate"),
    )
    s = s.withColumn("delisted_coverage_pct", X.ratio("delisted_coverage_count", "delisted_sample_count"))
    blockers = X.tags(
        (F.col("rows") == 0, "empty_audit_sample"),
        ((F.col("rows") > 0) & ~F.col("sip_access_verified"), "sip_access_not_verified"),
        ((F.col("rows") > 0) & (F.coalesce("delisted_coverage_pct", F.lit(0.0)) < 0.8), "delisted_coverage_below_80_pct"),
        ((F.col("rows") > 0) & ~F.col("sip_volume_exceeds_iex"), "sip_volume_not_confirmed_against_iex"),
        ((F.col("rows") > 0) & F.col("symbol_remapping_observed"), "symbol_remapping_observed"),
        ((F.col("rows") > 0) & ~F.col("ticker_change_coverage_adequate"), "ticker_change_coverage_inadequate"),
    )
    s = s.withColumn("__b", blockers)
    return s.withColumns({"backfill_recommendation": F.when(F.size("__b") > 0, "blocked").otherwise("proceed"), "backfill_recommendation_reason": F.coalesce(X.joined(F.col("__b")), F.lit("audit_gate_passed"))}).drop("rows", "__b")


def status_counts(report: DataFrame) -> DataFrame:
    return report.groupBy("audit_status").agg(F.count(F.lit(1)).alias("rows"))


def category_counts(report: DataFrame) -> DataFrame:
    return report.select(F.explode(F.split("sample_categories", ";")).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("rows"))
