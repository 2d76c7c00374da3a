"""State of a dataset as one row: counts, keys, date ranges, coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as X


def _day(df: DataFrame, column: str) -> Column:
    """column as a date; text and zoned timestamps by their UTC date, what cannot be read is null."""
    kind = dict(df.dtypes)[column]
    if kind in ("date", "timestamp", "timestamp_ntz"):
        return F.col(column).cast("date")
    return X.utc_date(column)


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: rows whose key occurs more than once (null if a key column is missing)."""
    if set(keys) - set(df.columns):
        return df.sparkSession.range(1).select(F.lit(None).cast("long").alias("duplicate_key_count"))
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("duplicate_key_count"))


def latest_coverage(df: DataFrame, date: str, entity: str | None, expected: int | None = None) -> DataFrame:
    """One row: latest date, its distinct entities, and their share of those expected (6 places).

    One pass: entities are counted per date with a partial aggregate, and the row of the last date is taken.
    """
    if entity is None or entity not in df.columns:
        return df.agg(F.max(_day(df, date)).cast("string").alias("latest_date"), F.lit(None).cast("long").alias("latest_date_coverage_count"), F.lit(None).cast("double").alias("latest_date_coverage_pct"))
    per_day = df.select(_day(df, date).alias("d"), F.col(entity).alias("e")).filter("d is not null").groupBy("d").agg(F.count_distinct("e").alias("n"))
    last = per_day.agg(F.max(F.struct("d", "n")).alias("last"))
    count = F.col("last.n")
    share = X.ratio(count, F.lit(expected)) if expected and expected > 0 else F.lit(None).cast("double")
    return last.select(F.col("last.d").cast("string").alias("latest_date"), count.alias("latest_date_coverage_count"), share.alias("latest_date_coverage_pct"))


def date_range(df: DataFrame, date: str) -> DataFrame:
    return df.agg(F.min(_day(df, date)).cast("string").alias("min_date"), F.max(_day(df, date)).cast("string").alias("max_date"))


def dimension_entities(df: DataFrame, dimension: str, entity: str) -> DataFrame:
    """Distinct entities of every value of a dimension; nulls on either side are left out."""
    known = df.filter(F.col(dimension).isNotNull() & F.col(entity).isNotNull())
    return known.groupBy(F.col(dimension).cast("string").alias("dimension")).agg(F.count_distinct(entity).alias("entities"))


def frame_state(df: DataFrame, keys: list[str] | None = None, required: list[str] | None = None, date: str | None = None, entity: str | None = None, expected: int | None = None, updated: str = "lastupdated") -> DataFrame:
    """One row of dataset state; columns appear for the arguments that are given."""
    pieces = [F.count(F.lit(1)).alias("row_count")]
    if entity is not None:
        pieces.append((F.count_distinct(entity) if entity in df.columns else F.lit(0).cast("long")).alias(f"{entity}_count"))
    if required:
        pieces.append(F.array(*[F.lit(c) for c in required if c not in df.columns]).cast("array<string>").alias("missing_required_columns"))
    if date is not None:
        pieces += [F.min(_day(df, date)).cast("string").alias("min_date"), F.max(_day(df, date)).cast("string").alias("max_date")]
    if updated in df.columns:
        pieces += [F.min(_day(df, updated)).cast("string").alias("provider_min_lastupdated"), F.max(_day(df, updated)).cast("string").alias("provider_max_lastupdated")]
    state = df.agg(*pieces)
    if keys:
        state = state.crossJoin(F.broadcast(duplicate_keys(df, keys)))  # one row each
    if date is not None:
        state = state.crossJoin(F.broadcast(latest_coverage(df, date, entity, expected)))
    return state


def reason_counts(df: DataFrame, column: str) -> DataFrame:
    """How often each tag occurs in the ';'-joined lists of column."""
    tags = df.select(F.explode(F.split(column, ";")).alias("reason")).filter("reason <> ''")
    return tags.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def flag_counts(df: DataFrame, **conditions: str) -> DataFrame:
    """One row: rows for which each named SQL condition holds."""
    return df.agg(*[F.count_if(F.coalesce(F.expr(c), F.lit(False))).alias(n) for n, c in conditions.items()])


def security_master_counts(master: DataFrame) -> DataFrame:
    return flag_counts(master, active_count="active", inactive_count="not active", price_coverage_eligible_count="is_price_coverage_eligible", identity_conflict_count="symbol_identity_conflict", known_reit_count="is_known_reit")


def episode_counts(episodes: DataFrame, **more: str) -> DataFrame:
    """Counts of episodes, and of the further named conditions in the same pass."""
    return flag_counts(
        episodes,
        current_episode_count="is_current_symbol",
        bounded_episode_count="episode_status = 'bounded'",
        unresolved_episode_count="episode_status = 'unresolved'",
        ineligible_episode_count="not is_price_coverage_eligible",
        unmappable_episode_count="not is_episode_mapping_eligible",
        mapping_quarantine_episode_count="is_price_coverage_eligible and not is_episode_mapping_eligible",
        **more,
    )


def ticker_counts(tickers: DataFrame) -> DataFrame:
    return flag_counts(
        tickers,
        current_episode_count="is_current_symbol",
        historical_episode_count="not is_current_symbol",
        mapping_eligible_episode_count="is_episode_mapping_eligible",
        mapping_quarantine_episode_count="not is_episode_mapping_eligible",
    )


def action_counts(actions: DataFrame) -> DataFrame:
    """Per action type: rows, matched and unmatched ones."""
    return actions.groupBy("action_type").agg(F.count(F.lit(1)).alias("events"), F.count_if(F.col("security_id").isNotNull()).alias("matched"), F.count_if(F.col("security_id").isNull()).alias("unmatched"))
