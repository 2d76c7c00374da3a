"""Published tables: columns, types and keys; and the shapes of landed provider pages."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

#: Default floor of the price history; every job takes it as a parameter.
HISTORY_START = dt.date(2016, 1, 1)

_STRINGS, _FLAGS, _DATES = T.StringType(), T.BooleanType(), T.DateType()


def _table(columns: str, flags: str = "", dates: str = "", other: dict[str, T.DataType] | None = None, required: str = "") -> T.StructType:
    """Columns in order; strings unless named as flags, dates or other types."""
    kinds = dict.fromkeys(flags.split(), _FLAGS) | dict.fromkeys(dates.split(), _DATES) | (other or {})
    return T.StructType([T.StructField(c, kinds.get(c, _STRINGS), c not in required.split()) for c in columns.split()])


# The column order of the published tables.
SECURITY_MASTER = _table(
    "security_id symbol company_name cik composite_figi share_class_figi identity_source instrument_type market locale "
    "currency primary_exchange active delisted_date last_updated_utc alpaca_asset_id alpaca_symbol alpaca_exchange "
    "alpaca_status alpaca_tradable sector industry is_nareit_listed is_sp500_reit is_known_reit is_excluded_structure "
    "structure_exclusion_reason has_alpaca_asset alpaca_asset_match_status coverage_reason in_price_history_window "
    "symbol_identity_conflict is_price_coverage_eligible exclusion_reason snapshot_date",
    flags="active alpaca_tradable is_nareit_listed is_sp500_reit is_known_reit is_excluded_structure has_alpaca_asset in_price_history_window symbol_identity_conflict is_price_coverage_eligible",
    dates="delisted_date snapshot_date",
    other={"last_updated_utc": T.TimestampType()},
)

TICKERS = _table(
    "episode_id security_id symbol provider_symbol company_name current_symbol symbol_valid_from symbol_valid_to "
    "is_current_symbol episode_status is_episode_mapping_eligible sector industry cik composite_figi share_class_figi "
    "primary_exchange active delisted_date alpaca_asset_id alpaca_status alpaca_tradable is_known_reit snapshot_date",
    flags="is_current_symbol is_episode_mapping_eligible active alpaca_tradable is_known_reit",
    dates="symbol_valid_from symbol_valid_to delisted_date snapshot_date",
)

EPISODES = _table(
    "episode_id security_id symbol company_name current_symbol symbol_valid_from symbol_valid_to is_current_symbol "
    "episode_source episode_status is_price_coverage_eligible is_episode_mapping_eligible security_exclusion_reason "
    "symbol_identity_conflict share_class_figi composite_figi cik primary_exchange snapshot_date",
    flags="is_current_symbol is_price_coverage_eligible is_episode_mapping_eligible symbol_identity_conflict",
    dates="symbol_valid_from symbol_valid_to snapshot_date",
)

ACTIONS = _table(
    "provider_event_id action_type process_date effective_date ex_date record_date payable_date primary_symbol "
    "related_symbol primary_cusip related_cusip security_id related_security_id identity_match_status "
    "related_identity_match_status old_rate new_rate rate cash_rate currency sub_type special foreign "
    "requires_split_history_refresh raw_payload_sha256 raw_payload_json snapshot_date",
    flags="special foreign requires_split_history_refresh",
    dates="process_date effective_date ex_date record_date payable_date snapshot_date",
)

BAR_SIDES = ("raw", "split_adjusted")
BAR_MEASURES = ("open", "high", "low", "close", "volume", "vwap", "trade_count")
BARS = _table(
    "security_id episode_id symbol current_symbol date "
    + " ".join(f"{side}_{m}" for side in BAR_SIDES for m in BAR_MEASURES)
    + " identity_status source_feed snapshot_date",
    dates="date snapshot_date",
    other={f"{side}_{m}": T.LongType() if m == "trade_count" else T.DoubleType() for side in BAR_SIDES for m in BAR_MEASURES},
    required="symbol date identity_status source_feed snapshot_date",
)

AUDIT_SAMPLE = _table(
    "sample_id security_id symbol company_name active delisted_date has_alpaca_asset symbol_identity_conflict "
    "sample_categories sample_roles known_event_type known_event_date symbol_valid_from symbol_valid_to",
    flags="active has_alpaca_asset symbol_identity_conflict",
    dates="delisted_date known_event_date symbol_valid_from symbol_valid_to",
)

AUDIT = T.StructType(
    AUDIT_SAMPLE.fields
    + _table(
        "request_start_date request_end_date feed adjustment asof returned_symbols raw_bar_count bar_count "
        "out_of_episode_bar_count first_bar_date last_bar_date total_volume pre_event_bar_count post_event_bar_count "
        "iex_comparison_start_date iex_bar_count iex_total_volume sip_comparison_volume sip_to_iex_volume_ratio "
        "request_error audit_status coverage_reason snapshot_date",
        dates="request_start_date request_end_date first_bar_date last_bar_date iex_comparison_start_date snapshot_date",
        other=dict.fromkeys("raw_bar_count bar_count out_of_episode_bar_count total_volume pre_event_bar_count post_event_bar_count iex_bar_count iex_total_volume sip_comparison_volume".split(), T.LongType())
        | {"sip_to_iex_volume_ratio": T.DoubleType()},
    ).fields
)

KEYS = {
    "security_master": ["security_id", "symbol"],
    "tickers": ["episode_id"],
    "universe_exclusions": ["security_id", "symbol"],
    "symbol_episodes": ["episode_id"],
    "corporate_actions": ["provider_event_id"],
    "historical": ["symbol", "date"],
    "identity_quarantine": ["symbol", "date"],
    "coverage_audit": ["sample_id"],
}

LISTING_ROW = (
    "ticker string, name string, type string, market string, locale string, currency_name string, primary_exchange string, "
    "active string, last_updated_utc string, delisted_utc string, share_class_figi string, composite_figi string, cik string"
)
ASSET_ROW = "id string, symbol string, exchange string, status string, tradable string"
NAME_CHANGE_ROW = "id string, old_symbol string, new_symbol string, old_cusip string, new_cusip string, process_date string"
BAR_ROW = "t string, o string, h string, l string, c string, v string, vw string, n string"
