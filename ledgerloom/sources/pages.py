"""Landed provider pages (JSON lines) as rows.

A landed page keeps its place: `page_no` (its file's name, its block of the file and its line's order) and the position
inside the page order rows where a rule says that the last occurrence counts. Files are named so that later ones sort
later (a date leads the name).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X
from .tables import store

# The provider's collections of corporate actions and the type each holds.
ACTION_TYPES = {
    "capital_gains_distributions": "capital_gains_distribution",
    "cash_dividends": "cash_dividend",
    "cash_mergers": "cash_merger",
    "forward_splits": "forward_split",
    "name_changes": "name_change",
    "partial_calls": "partial_call",
    "redemptions": "redemption",
    "reorganizations": "reorganization",
    "reverse_splits": "reverse_split",
    "rights_distributions": "rights_distribution",
    "spin_offs": "spin_off",
    "stock_and_cash_mergers": "stock_and_cash_merger",
    "stock_dividends": "stock_dividend",
    "stock_mergers": "stock_merger",
    "unit_splits": "unit_split",
    "worthless_removals": "worthless_removal",
}


#: What one task parses: text of so many bytes. Compressed files are taken to hold PACKED times their length.
TASK_BYTES, PACKED = 16 << 20, 16


def _tasks(spark: SparkSession, path: str) -> int:
    """How many tasks the lines under path are dealt to, by the lengths of its files; 1: they are so few that they stay."""
    fs, at = store(spark, path)
    found = fs.globStatus(at)
    length = sum(fs.getContentSummary(f.getPath()).getLength() for f in found or [])
    text = length * (PACKED if re.search(r"\.(gz|bz2|zst|lz4|snappy|deflate)(/|\*|$)", " ".join([path, *[f.getPath().toString() for f in found or []]])) else 1)
    return 1 if text <= TASK_BYTES else max(-(-text // TASK_BYTES), spark.sparkContext.defaultParallelism)


def landed_pages(spark: SparkSession, path: str) -> DataFrame:
    """(file, page_no, body) of the JSON lines under path, compressed or not; blank lines are skipped.

    page_no is ordered by file name, then by the place in the file, however Spark packs or splits files into tasks: the
    lines of one block of a file are read by one task in their order. A compressed file is read by one task whatever its
    length, and Spark packs several into one; so numbered lines are dealt out to tasks that grow in number, not in size,
    before they are parsed.
    """
    at = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line"))
    lines = spark.read.text(path).select(at.alias("page_no"), F.col("value").alias("body"))
    lines = lines.filter(F.length(F.trim("body")) > 0)
    tasks = _tasks(spark, path)
    return (lines.repartition(tasks, "page_no") if tasks > 1 else lines).select("page_no.file", "page_no", "body")


def _checked(condition: Column, message: Column | str) -> Column:
    return F.when(condition, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))


def _kind(value: Column) -> Column:
    return F.schema_of_variant(value)


def _array_or_none(value: Column, name: str) -> Column:
    """True where a variant is missing, null or an array; raises otherwise."""
    ok = value.isNull() | _kind(value).startswith("ARRAY") | (_kind(value) == "VOID")
    return _checked(ok, F.lit(f"{name} must be an array"))


def _objects(pages: DataFrame, path: str, row: str, extra: list[str]) -> DataFrame:
    """One row per object of the array at path of every page: extra, pos, and the fields of row (text)."""
    parsed = pages.withColumn("__v", F.try_variant_get(F.parse_json("body"), path, "variant"))
    parsed = parsed.filter(_array_or_none(F.col("__v"), path.removeprefix("$.")))
    values = parsed.select(*extra, F.posexplode(F.col("__v").cast("array<variant>")).alias("pos", "__row"))
    objects = values.filter(_kind(F.col("__row")).startswith("OBJECT"))
    fields = [c.split()[0] for c in row.split(",")]
    return objects.select(*extra, "pos", *[F.try_variant_get("__row", f"$.{c}", "string").alias(c) for c in fields])


def listing_rows(pages: DataFrame) -> DataFrame:
    """Every listing of every page's `results`; entries that are no objects are skipped, a `results` that is no array fails."""
    return _objects(pages, "$.results", S.LISTING_ROW, ["page_no"])


def asset_rows(pages: DataFrame) -> DataFrame:
    """Normalised assets of `{"assets": [...]}` pages, without blank symbols."""
    return normalised_assets(_objects(pages, "$.assets", S.ASSET_ROW, ["page_no"]))


def normalised_assets(rows: DataFrame) -> DataFrame:
    out = rows.select(
        X.join_key("symbol").alias("symbol_join_key"),
        X.clean("id").alias("alpaca_asset_id"),
        X.symbol("symbol").alias("alpaca_symbol"),
        F.upper(X.clean("exchange")).alias("alpaca_exchange"),
        F.lower(X.clean("status")).alias("alpaca_status"),
        X.nullable_bool("tradable").alias("alpaca_tradable"),
    )
    return out.filter("alpaca_symbol is not null")


def name_change_rows(pages: DataFrame) -> DataFrame:
    """Valid name changes of `corporate_actions.name_changes`, not yet deduplicated."""
    return normalised_name_changes(_objects(pages, "$.corporate_actions.name_changes", S.NAME_CHANGE_ROW, ["page_no"]).withColumnRenamed("id", "event_id"))


def normalised_name_changes(rows: DataFrame) -> DataFrame:
    """Both symbols given, different and symbol-like, and a date (rows: event_id, symbols, cusips, process_date)."""
    cusip = lambda c: X.clean(c).alias(c) if c in rows.columns else F.lit(None).cast("string").alias(c)
    out = rows.select(X.clean("event_id").alias("event_id"), X.utc_date("process_date").alias("process_date"), X.symbol("old_symbol").alias("old_symbol"), X.symbol("new_symbol").alias("new_symbol"), cusip("old_cusip"), cusip("new_cusip"))
    pattern = X.SYMBOL_PATTERN
    return out.filter((F.col("old_symbol") != F.col("new_symbol")) & F.col("process_date").isNotNull() & F.col("old_symbol").rlike(pattern) & F.col("new_symbol").rlike(pattern))


def action_rows(pages: DataFrame) -> DataFrame:
    """(page_no, pos, action_type, raw): every action of every collection, raw as JSON text.

    An unknown collection, a collection that is no array and an entry that is no object fail the query. Kinds are read from
    the parsed value, raw from the text, in which a number keeps its fraction (`1.0` is not `1`).
    """
    own = F.from_json("body", "corporate_actions map<string, string>")["corporate_actions"]
    parsed = pages.select("page_no", F.try_variant_get(F.parse_json("body"), "$.corporate_actions", "variant").alias("__v"), own.alias("__own"))
    is_map = F.col("__v").isNull() | _kind(F.col("__v")).startswith("OBJECT") | (_kind(F.col("__v")) == "VOID")
    parsed = parsed.filter(_checked(is_map, "corporate_actions must be an object"))
    each = parsed.select("page_no", "__own", F.explode(F.col("__v").cast("map<string,variant>")).alias("collection", "__values"))
    types = F.create_map(*[F.lit(x) for pair in ACTION_TYPES.items() for x in pair])
    each = each.withColumn("action_type", types[F.col("collection")])
    each = each.filter(_checked(F.col("action_type").isNotNull(), F.concat(F.lit("unsupported corporate-action collection: "), F.col("collection"))))
    each = each.filter(_checked(_kind(F.col("__values")).startswith("ARRAY"), F.concat(F.lit("corporate_actions."), F.col("collection"), F.lit(" must be an array"))))
    texts = F.from_json(F.col("__own")[F.col("collection")], "array<string>")
    entries = F.transform(F.col("__values").cast("array<variant>"), lambda v, i: F.struct(v.alias("value"), F.get(texts, i).alias("raw")))
    rows = each.select("page_no", "collection", "action_type", F.posexplode(entries).alias("pos", "__entry"))
    rows = rows.filter(_checked(_kind(F.col("__entry.value")).startswith("OBJECT"), F.concat(F.lit("corporate_actions."), F.col("collection"), F.lit(" entries must be objects"))))
    return rows.select("page_no", "pos", "action_type", F.col("__entry.raw").alias("raw"))


def bar_rows(pages: DataFrame, prefix: str) -> DataFrame:
    """(page_no, pos, symbol, date, prefix_open ... prefix_trade_count) of pages whose `bars` map symbols to arrays."""
    shape = F.from_json("body", f"bars map<string, array<struct<{S.BAR_ROW.replace(' string', ': string')}>>>")
    bars = pages.select("page_no", F.explode(shape["bars"]).alias("symbol", "__bars"))
    bars = bars.select("page_no", "symbol", F.posexplode("__bars").alias("pos", "b"))
    measures = dict(zip(S.BAR_MEASURES, ("o", "h", "l", "c", "v", "vw", "n")))
    return bars.select(
        "page_no",
        "pos",
        F.upper("symbol").alias("symbol"),
        X.utc_date("b.t").alias("date"),
        *[(X.number(f"b.{k}").try_cast("bigint") if m == "trade_count" else X.number(f"b.{k}")).alias(f"{prefix}_{m}") for m, k in measures.items()],
    ).filter("date is not null")


def audit_rows(pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Audit envelopes as observations and request results.

    observations: (feed, requested, returned, date, volume); results: (feed, requested, returned_symbols, request_error).
    """
    bar = "struct<t: string, v: string>"
    shape = F.from_json("body", f"request struct<symbols: array<string>, feed: string>, response struct<bars: map<string, array<{bar}>>>, error string")
    envelopes = pages.select(shape.alias("e")).select(F.col("e.request.feed").alias("feed"), F.element_at("e.request.symbols", 1).alias("requested"), F.col("e.response.bars").alias("bars"), F.col("e.error").alias("error"))
    volume = F.coalesce(X.number("bar.v").try_cast("bigint"), F.lit(0))
    seen = envelopes.select("feed", "requested", F.explode("bars").alias("returned", "__bars")).select("feed", "requested", "returned", F.explode("__bars").alias("bar"))
    observations = seen.select("feed", "requested", "returned", X.utc_date("bar.t").alias("date"), volume.alias("volume")).filter("date is not null")
    names = envelopes.select("feed", "requested", "error", F.explode_outer(F.map_keys("bars")).alias("returned"))
    results = names.groupBy("feed", "requested").agg(F.array_sort(F.collect_set("returned")).alias("returned_symbols"), F.max("error").alias("request_error"))
    return observations, results


def landed_page_count(manifests: DataFrame) -> DataFrame:
    """Pages landed by the latest manifest of every batch and adjustment (batch_id, adjustment, snapshot_date, page_count)."""
    latest = manifests.groupBy("batch_id", "adjustment").agg(F.max_by("page_count", "snapshot_date").alias("page_count"))
    return latest.agg(F.coalesce(F.sum("page_count"), F.lit(0)).cast("long").alias("request_count"))
