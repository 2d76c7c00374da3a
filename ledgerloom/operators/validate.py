"""Checks that fail a job early with a clear message."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, columns: Iterable[str], what: str) -> None:
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ValueError(f"{what} missing required columns: {missing}")


def require_unique(df: DataFrame, keys: list[str], what: str) -> DataFrame:
    """df, if no key occurs twice (one aggregate over the keys)."""
    twice = df.groupBy(*keys).count().filter("count > 1").limit(3).collect()
    if twice:
        raise ValueError(f"{what} is not unique in {keys}: {[tuple(r)[:-1] for r in twice]}")
    return df


def require_values(df: DataFrame, column: str, wanted: Iterable[str], what: str) -> None:
    """Every wanted value occurs in the ';'-joined lists of column."""
    wanted = list(wanted)
    seen = df.select(F.explode(F.split(column, ";")).alias("v")).filter(F.col("v").isin(*wanted)).distinct().collect()
    missing = sorted(set(wanted) - {r["v"] for r in seen})
    if missing:
        raise ValueError(f"{what} missing required categories: {missing}")


def require_action_keys(actions: DataFrame) -> None:
    """Every action has an id and a process date."""
    bad = actions.filter("provider_event_id is null or process_date is null").select("action_type", "provider_event_id").limit(3).collect()
    if bad:
        first = bad[0]
        lacks = "id" if first["provider_event_id"] is None else "process_date"
        raise ValueError(f"corporate action {first['provider_event_id'] or first['action_type']} is missing {lacks}")


def require_at_least(value: int, least: int, name: str) -> None:
    if value < least:
        raise ValueError(f"{name} must be at least {least}")


def require_one_of(value: str, allowed: Iterable[str], name: str) -> None:
    if value not in set(allowed):
        raise ValueError(f"{name} must be one of {sorted(allowed)}")
