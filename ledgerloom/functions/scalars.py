"""Column expressions for cleaning identifiers, symbols, dates and provider payloads.

All but the canonical form of payloads with fractions are built-in functions: they stay inside whole-stage code generation
and push down where Spark can.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import payloads

Name = str | Column

# Parts of a parameter name that mark its value as secret.
SENSITIVE = "api_key|apikey|secret|token|authorization"
# Fixed value: symbols that a name change may carry; CUSIP-like pseudo-symbols begin with a digit and fail.
SYMBOL_PATTERN = r"^[A-Z][A-Z0-9.\-]{0,14}$"
# Action types that change the share count, and those that end a company.
SPLIT_TYPES = ("forward_split", "reverse_split", "unit_split")
MERGER_TYPES = ("cash_merger", "stock_merger", "stock_and_cash_merger")


def col(x: Name) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clean(x: Name) -> Column:
    """Text without white space at its ends; nothing left: null."""
    return F.nullif(F.regexp_replace(col(x).cast("string"), r"^[\s\x{A0}]+|[\s\x{A0}]+$", ""), F.lit(""))


def symbol(x: Name) -> Column:
    return F.upper(clean(x))


def join_key(x: Name) -> Column:
    """Spelling of a symbol that providers share: dots become dashes."""
    return F.translate(symbol(x), ".", "-")


def cik(x: Name) -> Column:
    """Digits only, at least ten with leading zeros; no digit: null."""
    digits = F.nullif(F.regexp_replace(clean(x), "[^0-9]", ""), F.lit(""))
    return F.when(F.length(digits) < 10, F.lpad(digits, 10, "0")).otherwise(digits)


def nullable_bool(x: Name) -> Column:
    """true/1/yes and false/0/no in any case; other non-empty text is true, empty text false, null stays null."""
    raw = col(x).cast("string")
    text = F.lower(F.trim(raw))
    return F.when(text.isin("true", "1", "yes"), True).when(text.isin("false", "0", "no"), False).when(raw.isNotNull(), F.length(raw) > 0)


def optional_bool(x: Name) -> Column:
    """A boolean as it is; other values by truthiness (empty text and 0 are false)."""
    text = col(x).cast("string")
    return F.when(text.isNotNull(), ~F.lower(text).isin("", "false", "0", "0.0"))


def utc_timestamp(x: Name) -> Column:
    """Timestamp in UTC; anything that cannot be read: null."""
    return F.try_to_timestamp(col(x).cast("string"))


def utc_date(x: Name) -> Column:
    return F.to_date(utc_timestamp(x))


def number(x: Name) -> Column:
    value = col(x).try_cast("double")
    return F.when(~F.isnan(value), value)


def integer(x: Name) -> Column:
    """Whole numbers; a fraction given as a number is cut, a fraction given as text is null."""
    return col(x).try_cast("bigint")


def security_identity(symbol_: Name, name: Name, exchange: Name, share_class: Name, composite: Name, cik_: Name) -> tuple[Column, Column]:
    """The most stable identity a listing has, and which kind it is."""
    fallback = F.concat_ws("|", *[F.coalesce(col(x), F.lit("")) for x in (exchange, symbol_, name)])
    source = (
        F.when(col(share_class).isNotNull(), "share_class_figi")
        .when(col(composite).isNotNull(), "composite_figi")
        .when(col(cik_).isNotNull(), "cik_symbol")
        .otherwise("massive_fallback")
    )
    value = F.coalesce(col(share_class), col(composite), F.concat_ws(":", F.nullif(col(cik_), F.lit("")), col(symbol_)))
    value = F.when(source == "massive_fallback", F.substring(F.sha2(fallback, 256), 1, 20)).otherwise(value)
    return F.concat_ws(":", source, value), source


# Name patterns of excluded company structures, the first that matches counts.
STRUCTURES = (
    ("business_development_company", r"\bBUSINESS DEVELOPMENT (?:COMPANY|CORPORATION)\b|\bBDC\b"),
    ("limited_partnership", r"\bL\.?P\.?\b|\bLIMITED PARTNERSHIP\b"),
)


def structure_reason(name: Name) -> Column:
    found = F.lit(None).cast("string")
    for reason, pattern in reversed(STRUCTURES):
        found = F.when(col(name).rlike(f"(?i){pattern}"), reason).otherwise(found)
    return found


def in_window(active: Name, delisted: Name, floor: dt.date) -> Column:
    """Active, or never delisted, or delisted on the floor date or later."""
    return F.coalesce(col(active), F.lit(False)) | col(delisted).isNull() | (col(delisted) >= F.lit(floor))


def tags(*conditions: tuple[Column, str | Column]) -> Column:
    """Distinct tags whose condition holds, in order, as an array."""
    each = [F.when(F.coalesce(c, F.lit(False)), t if isinstance(t, Column) else F.lit(t)) for c, t in conditions]
    return F.array_distinct(F.array_compact(F.array(*each)))


def joined(values: Column) -> Column:
    """An array as ';'-joined text; empty: null."""
    return F.nullif(F.array_join(values, ";"), F.lit(""))


def without(text: Name, tag: str) -> Column:
    """A ';'-joined list without one tag; nothing left: null."""
    return joined(F.array_remove(F.split(F.coalesce(col(text), F.lit("")), ";"), tag))


def first_true(*values: Column) -> Column:
    """The first value that is neither null, empty, nor zero."""
    return F.coalesce(*[F.when(~F.trim(v.cast("string")).isin("", "0", "0.0", "false"), v) for v in values])


def event_date(effective: Name, ex: Name, payable: Name, process: Name) -> Column:
    return F.coalesce(col(effective), col(ex), col(payable), col(process))


def match_date(action_type: Name, event: Name) -> Column:
    """The day on which the primary symbol is looked up: the day before for events that end a symbol."""
    ends = col(action_type).isin("name_change", "unit_split", *MERGER_TYPES)
    return F.when(ends, F.date_sub(col(event), 1)).otherwise(col(event))


def is_split(action_type: Name) -> Column:
    return col(action_type).isin(*SPLIT_TYPES)


def canonical_json(text: Name) -> Column:
    """JSON with sorted keys, no blanks and numbers as Python prints them. Text that is no JSON: null."""
    return payloads.canonical_json(col(text))


def sha256(text: Name) -> Column:
    return F.sha2(col(text), 256)


def episode_id(security: Name, symbol_: Name, start: Name) -> Column:
    return F.concat_ws("|", col(security), col(symbol_), F.coalesce(col(start).cast("string"), F.lit("unknown")))


def latest_session(snapshot: Name) -> Column:
    """The last weekday before the snapshot date."""
    day = F.date_sub(col(snapshot), 1)
    return F.date_sub(day, F.greatest(F.weekday(day) - 4, F.lit(0)))


def overlaps(a_from: Name, a_to: Name, b_from: Name, b_to: Name) -> Column:
    """Inclusive intervals that meet; an unknown start always overlaps, an unknown end is open."""
    a_from, a_to, b_from, b_to = map(col, (a_from, a_to, b_from, b_to))
    unknown = a_from.isNull() | b_from.isNull()
    return unknown | ((b_to.isNull() | (a_from <= b_to)) & (a_to.isNull() | (b_from <= a_to)))


def within(day: Name, start: Name, end: Name, floor: dt.date | None = None) -> Column:
    """day lies in the interval; an unknown start counts as the floor (or as unbounded), an unknown end as open."""
    day, start, end = map(col, (day, start, end))
    begins = F.coalesce(start, F.lit(floor)) <= day if floor is not None else start.isNull() | (start <= day)
    return begins & (end.isNull() | (day <= end))


def ratio(a: Name, b: Name, places: int = 6) -> Column:
    return F.round(F.try_divide(col(a).cast("double"), col(b).cast("double")), places)


def set_digest(values: Name) -> Column:
    """Aggregate: sha256 of the distinct values, sorted, one a line."""
    return F.sha2(F.array_join(F.array_sort(F.collect_set(col(values))), "\n"), 256)


def redacted(params: Name) -> Column:
    """A map of request parameters with the values of secret keys replaced."""
    return F.transform_values(col(params), lambda k, v: F.when(F.translate(F.lower(k), "-", "_").rlike(SENSITIVE), F.lit("[REDACTED]")).otherwise(v))


def safe_url(url: Name) -> Column:
    """A URL without query and fragment."""
    return F.regexp_replace(col(url), r"[?#].*$", "")


def scrubbed(text: Name, *secrets: str) -> Column:
    """Text in which known secret values are replaced."""
    out = col(text)
    for s in secrets:
        out = F.replace(out, F.lit(s), F.lit("[REDACTED]")) if s else out
    return out
