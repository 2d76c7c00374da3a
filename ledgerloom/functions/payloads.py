"""Canonical JSON of provider payloads: sorted keys, no blanks, numbers as Python prints them, characters as they are."""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: What is left of a payload without its strings that built-in functions do not print as Python does: fractions, exponents,
#: long whole numbers, and minus zero.
_OTHER_NUMBERS = r"[0-9][.eE]|[0-9]{18}|-0|NaN|Infinity"
#: Characters that they escape otherwise or, beyond the 16-bit ones, sort otherwise.
_OTHER_TEXT = "[\\\\\\x00-\\x1f\\x7f-\\x9f\\x{2028}\\x{2029}\\x{10000}-\\x{10FFFF}]"


_ENCODER = json.JSONEncoder(sort_keys=True, separators=(",", ":"), ensure_ascii=False)
_DECODER = json.JSONDecoder()


def canonical_text(text: str | None) -> str | None:
    """One payload; None if it is no JSON."""
    if text is None:
        return None
    try:
        try:
            value, end = _DECODER.raw_decode(text)
        except json.JSONDecodeError:
            end = -1  # no JSON, or blanks before it
        return _ENCODER.encode(value if end == len(text) else json.loads(text))
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(StringType())
def _canonical(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield texts.map(canonical_text, na_action="ignore")


def canonical_json(text: Column) -> Column:
    """JSON with sorted keys (of repeated keys the last counts), no blanks and numbers in Python's spelling; no JSON: null.

    Payloads of plain strings, whole numbers, booleans and nulls are printed by built-in functions. The others, which
    those would spell otherwise (`1.0` as `1`), go through one Arrow batch function; it is handed nulls for all the rest.
    Its result comes first, so that what it has spelled is not tried by built-in functions once more.
    """
    bare = F.regexp_replace(text, r'"[^"\\]*"', '""')
    plain = ~bare.rlike(_OTHER_NUMBERS) & ~text.rlike(_OTHER_TEXT)
    quick = F.when(plain, F.to_json(F.try_parse_json(text)))
    return F.coalesce(_canonical(F.when(quick.isNull(), text)), quick)
