"""Security master: listings with stable identities, reference data and explicit exclusion reasons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X

# Exchanges whose listings count.
ELIGIBLE_EXCHANGES = ("ARCX", "BATS", "IEXG", "LTSE", "XASE", "XNAS", "XNYS")
REIT = r"(?i)\bREIT\b"


def normalised_listings(rows: DataFrame) -> DataFrame:
    """Listings with cleaned fields and identities; `ordinal` keeps the input order. Blank symbols are dropped.

    rows: the listing fields, plus page_no and pos if they come from landed pages.
    """
    order = F.struct(*[F.col(c) for c in ("page_no", "pos") if c in rows.columns] or [F.lit(0)])
    lower = lambda c, default: F.coalesce(F.lower(X.clean(c)), F.lit(default)).alias(c)
    base = rows.select(
        X.symbol("ticker").alias("symbol"),
        X.join_key("ticker").alias("symbol_join_key"),
        X.clean("name").alias("company_name"),
        X.cik("cik").alias("cik"),
        F.upper(X.clean("composite_figi")).alias("composite_figi"),
        F.upper(X.clean("share_class_figi")).alias("share_class_figi"),
        F.coalesce(F.upper(X.clean("type")), F.lit("CS")).alias("instrument_type"),
        lower("market", "stocks"),
        lower("locale", "us"),
        F.upper(X.clean("currency_name")).alias("currency"),
        F.upper(X.clean("primary_exchange")).alias("primary_exchange"),
        F.coalesce(X.nullable_bool("active"), F.lit(False)).alias("active"),
        X.utc_date("delisted_utc").alias("delisted_date"),
        X.utc_timestamp("last_updated_utc").alias("last_updated_utc"),
        order.alias("ordinal"),
    ).filter("symbol is not null")
    security, source = X.security_identity("symbol", "company_name", "primary_exchange", "share_class_figi", "composite_figi", "cik")
    return base.withColumns({"security_id": security, "identity_source": source})


def one_per_security(listings: DataFrame) -> DataFrame:
    """Of each (security, symbol) the row updated last, active before inactive, the last one landed on a tie.

    Repeats combine before they are shuffled, as in all "last row of a key" steps.
    """
    rest = [c for c in listings.columns if c not in ("security_id", "symbol", "ordinal")]
    row = F.max_by(F.struct(*rest), F.struct("last_updated_utc", "active", "ordinal")).alias("row")
    return listings.groupBy("security_id", "symbol").agg(row).select("security_id", "symbol", "row.*").select(*[c for c in listings.columns if c != "ordinal"])


def one_asset_per_key(assets: DataFrame) -> DataFrame:
    """Of each join key the first asset by status and id, nulls last."""
    first = F.struct(*[x for c in ("alpaca_status", "alpaca_asset_id") for x in (F.col(c).isNull(), F.col(c))])
    row = F.min_by(F.struct(*assets.columns), first).alias("row")
    return assets.groupBy("symbol_join_key").agg(row).select("row.*")


def security_master(listings: DataFrame, assets: DataFrame, snapshot: dt.date, reit_symbols: DataFrame | None = None, classifications: DataFrame | None = None, history_start: dt.date = S.HISTORY_START, reit_pattern: str = REIT) -> DataFrame:
    """The security master. listings: listing rows; assets: normalised assets; the other tables are optional.

    The reference tables join on one row per key, so a join never multiplies listings; Spark broadcasts them while
    they are small and sorts them otherwise.
    """
    frame = one_per_security(normalised_listings(listings))
    frame = frame.join(one_asset_per_key(assets), "symbol_join_key", "left")
    if classifications is not None:
        best = F.min_by(F.struct(F.trim("sector").alias("sector"), F.trim("industry").alias("industry")), "symbol")
        sectors = classifications.filter("symbol_join_key is not null").groupBy("symbol_join_key").agg(best.alias("r"))
        frame = frame.join(sectors.select("symbol_join_key", "r.sector", "r.industry"), "symbol_join_key", "left")
    else:
        frame = frame.withColumns({"sector": F.lit(None).cast("string"), "industry": F.lit(None).cast("string")})
    if reit_symbols is not None:
        keys = reit_symbols.select(X.join_key("symbol").alias("symbol_join_key")).filter("symbol_join_key is not null").distinct()
        frame = frame.join(keys.withColumn("is_nareit_listed", F.lit(True)), "symbol_join_key", "left")
    else:
        frame = frame.withColumn("is_nareit_listed", F.lit(False))
    by_symbol = Window.partitionBy("symbol")
    matched = F.when(F.col("alpaca_asset_id").isNull(), "no_current_asset").when(F.col("symbol") == F.col("alpaca_symbol"), "exact_symbol").otherwise("normalized_symbol")
    frame = frame.withColumns(
        {
            "is_nareit_listed": F.coalesce("is_nareit_listed", F.lit(False)),
            "is_sp500_reit": F.coalesce(F.col("industry").rlike(reit_pattern), F.lit(False)),
            "structure_exclusion_reason": X.structure_reason("company_name"),
            "has_alpaca_asset": F.col("alpaca_asset_id").isNotNull(),
            "alpaca_asset_match_status": matched,
            "in_price_history_window": X.in_window("active", "delisted_date", history_start),
            # every listing counts, excluded ones too
            "symbol_identity_conflict": F.min("security_id").over(by_symbol) != F.max("security_id").over(by_symbol),
            "snapshot_date": F.lit(snapshot),
        }
    )
    status = F.col("alpaca_asset_match_status")
    frame = frame.withColumns(
        {
            "is_known_reit": F.col("is_nareit_listed") | F.col("is_sp500_reit"),
            "is_excluded_structure": F.col("structure_exclusion_reason").isNotNull(),
            "coverage_reason": F.when(status == "normalized_symbol", "provider_symbol_spelling_differs").when(status == "no_current_asset", "no_current_alpaca_asset"),
        }
    )
    reasons = X.tags(
        (F.col("instrument_type") != "CS", "not_common_stock"),
        ((F.col("market") != "stocks") | (F.col("locale") != "us"), "not_us_stock"),
        (F.col("currency") != "USD", "non_usd_currency"),
        (~F.coalesce(F.col("primary_exchange").isin(*ELIGIBLE_EXCHANGES), F.lit(False)), "ineligible_exchange"),
        (F.col("is_known_reit"), "known_reit_or_reoc"),
        (F.col("is_excluded_structure"), F.col("structure_exclusion_reason")),
        (~F.col("in_price_history_window"), "delisted_before_history_window"),
        (F.col("symbol_identity_conflict"), "ambiguous_reused_symbol"),
    )
    frame = frame.withColumn("exclusion_reason", X.joined(reasons)).withColumn("is_price_coverage_eligible", F.col("exclusion_reason").isNull())
    return frame.select(*[F.col(f.name).cast(f.dataType) for f in S.SECURITY_MASTER.fields])


def pending_tickers(master: DataFrame) -> DataFrame:
    """Acquisition manifest of the eligible listings, before their symbols have dated episodes."""
    own = {
        "episode_id": F.concat_ws("|", "security_id", "symbol", F.lit("pending")),
        "provider_symbol": F.coalesce("alpaca_symbol", "symbol"),
        "current_symbol": F.when(F.col("active"), F.col("symbol")),
        "symbol_valid_from": F.lit(None),
        "symbol_valid_to": F.col("delisted_date"),
        "is_current_symbol": F.col("active"),
        "episode_status": F.lit("pending_episode_enrichment"),
        "is_episode_mapping_eligible": F.lit(False),
    }
    eligible = master.filter("is_price_coverage_eligible")
    return eligible.select(*[own.get(f.name, F.col(f.name) if f.name in master.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in S.TICKERS.fields])


def exclusions(master: DataFrame) -> DataFrame:
    return master.filter("not is_price_coverage_eligible")
