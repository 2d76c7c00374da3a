"""One query per operator over the star-schema tables, and the SQL that states the same result."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X
from ..operators import actions as A
from ..operators import audit as U
from ..operators import bars as B
from ..operators import episodes as E
from ..operators import identity as I
from ..operators import metrics as M
from ..sources import html_tables as H
from ..sources import pages as P
from ..streaming.ingest import ingest, ingested
from .fixtures import FLOOR, SNAPSHOT, table, view, with_views

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = with_views(sql, *views) if views else sql.strip()
        return f

    return register


# ---- dataset state


@query("""
SELECT count(*) AS row_count, count(DISTINCT l_partkey) AS l_partkey_count, CAST(min(CAST(l_shipdate AS DATE)) AS VARCHAR) AS min_date,
  CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS max_date,
  (SELECT CAST(coalesce(sum(n), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_partkey HAVING count(*) > 1)) AS duplicate_key_count,
  CAST(max(CAST(l_shipdate AS DATE)) AS VARCHAR) AS latest_date,
  (SELECT count(DISTINCT l_partkey) FROM lineitem WHERE CAST(l_shipdate AS DATE) = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)) AS latest_date_coverage_count,
  round((SELECT count(DISTINCT l_partkey) FROM lineitem WHERE CAST(l_shipdate AS DATE) = (SELECT max(CAST(l_shipdate AS DATE)) FROM lineitem)) / 2000.0::DOUBLE, 6) AS latest_date_coverage_pct
FROM lineitem""")
def frame_state(spark: SparkSession, d: str) -> DataFrame:
    return M.frame_state(table(spark, d, "lineitem"), ["l_orderkey", "l_partkey"], None, "l_shipdate", "l_partkey", 2000)


@query("""
SELECT CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS latest_date, count(DISTINCT o_custkey) AS latest_date_coverage_count,
  round(count(DISTINCT o_custkey) / 1500.0::DOUBLE, 6) AS latest_date_coverage_pct
FROM orders WHERE CAST(o_orderdate AS DATE) = (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) GROUP BY 1""")
def latest_coverage(spark: SparkSession, d: str) -> DataFrame:
    return M.latest_coverage(table(spark, d, "orders"), "o_orderdate", "o_custkey", 1500)


@query("SELECT event_type AS dimension, count(DISTINCT user_id) AS entities FROM events WHERE event_type IS NOT NULL AND user_id IS NOT NULL GROUP BY 1")
def dimension_entities(spark: SparkSession, d: str) -> DataFrame:
    return M.dimension_entities(table(spark, d, "events"), "event_type", "user_id")


@query("SELECT CAST(coalesce(sum(n), 0) AS BIGINT) AS duplicate_key_count FROM (SELECT count(*) AS n FROM events GROUP BY user_id, event_type HAVING count(*) > 1)")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return M.duplicate_keys(table(spark, d, "events"), ["user_id", "event_type"])


@query("SELECT CAST(min(CAST(ts AS DATE)) AS VARCHAR) AS min_date, CAST(max(CAST(ts AS DATE)) AS VARCHAR) AS max_date FROM events")
def date_range(spark: SparkSession, d: str) -> DataFrame:
    return M.date_range(table(spark, d, "events"), "ts")


# ---- scalar functions


@query(r"""
SELECT p_partkey, upper(trim(p_brand)) AS symbol, replace(upper(trim(p_brand || '.' || p_size)), '.', '-') AS join_key,
  CASE WHEN regexp_matches(p_name, '(?i)\bLP\b') THEN 'limited_partnership' END AS structure,
  lower(trim(p_type)) IN ('true', '1', 'yes') AS flag
FROM part""")
def symbol_keys(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    flag = F.coalesce(X.nullable_bool(F.when(F.lower(F.trim("p_type")).isin("true", "1", "yes"), F.col("p_type")).otherwise("no")), F.lit(False))
    return part.select("p_partkey", X.symbol("p_brand").alias("symbol"), X.join_key(F.concat("p_brand", F.lit("."), "p_size")).alias("join_key"), X.structure_reason("p_name").alias("structure"), flag.alias("flag"))


@query("""
SELECT s_suppkey, CASE WHEN length(d) = 0 THEN NULL WHEN length(d) < 10 THEN lpad(d, 10, '0') ELSE d END AS cik
FROM (SELECT s_suppkey, regexp_replace(s_name, '[^0-9]', '', 'g') || CAST(s_suppkey AS VARCHAR) AS d FROM supplier)""")
def cik_norm(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "supplier").select("s_suppkey", X.cik(F.concat(F.lit(" "), "s_name", F.lit("/"), F.col("s_suppkey").cast("string"))).alias("cik"))


@query("""
SELECT event_id, CAST(CAST(ts AS DATE) - 1 - CAST(greatest(isodow(CAST(ts AS DATE) - 1) - 5, 0) AS INT) AS DATE) AS session,
  try_cast(json_extract_string(props, '$.k') AS DOUBLE) AS k, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k_int
FROM events""")
def sessions_and_numbers(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    return table(spark, d, "events").select("event_id", X.latest_session(F.col("ts").cast("date")).alias("session"), X.number(k).alias("k"), X.integer(k).alias("k_int"))


@query("SELECT r_name AS region, sha256(string_agg(DISTINCT n_name, chr(10) ORDER BY n_name)) AS digest FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def set_digests(spark: SparkSession, d: str) -> DataFrame:
    both = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return both.groupBy(F.col("r_name").alias("region")).agg(X.set_digest("n_name").alias("digest"))


@query("""
SELECT page_id, regexp_replace(url, '[?#].*$', '') AS safe_url, '[REDACTED]' AS api_key, lang AS lang
FROM (SELECT page_id, url, split_part(url, '/', 4) AS lang FROM pages)""")
def redactions(spark: SparkSession, d: str) -> DataFrame:
    params = F.create_map(F.lit("Api-Key"), F.col("url"), F.lit("lang"), F.split_part("url", F.lit("/"), F.lit(4)))
    rows = table(spark, d, "pages").select("page_id", X.safe_url("url").alias("safe_url"), X.redacted(params).alias("p"))
    return rows.select("page_id", "safe_url", F.col("p")["Api-Key"].alias("api_key"), F.col("p")["lang"].alias("lang"))


# ---- daily bars

_BAR_VIEWS = ("v_episodes", "v_bars_raw", "v_bars_split")
_PAIRS = """
, p AS (SELECT coalesce(r.symbol, s.symbol) AS symbol, coalesce(r.date, s.date) AS date, raw_low, raw_high, raw_close, raw_volume, raw_trade_count,
    split_adjusted_close, split_adjusted_volume, CASE WHEN s.symbol IS NULL THEN 'raw_only' WHEN r.symbol IS NULL THEN 'split_only' ELSE 'both' END AS pair
  FROM v_bars_raw r FULL JOIN v_bars_split s ON r.symbol = s.symbol AND r.date = s.date)"""
_MAPPED = (
    _PAIRS
    + """
, h AS (SELECT p.symbol, p.date, count(e.episode_id) AS n, min(e.security_id) AS security_id, min(e.episode_id) AS episode_id, bool_and(e.is_episode_mapping_eligible) AS fine
  FROM p LEFT JOIN v_episodes e ON e.symbol = p.symbol AND p.date >= coalesce(e.symbol_valid_from, DATE '1996-01-01') AND (e.symbol_valid_to IS NULL OR p.date <= e.symbol_valid_to)
  GROUP BY 1, 2)
, m AS (SELECT p.*, count(*) OVER (PARTITION BY p.symbol, p.date) AS copies, CASE WHEN n = 1 THEN security_id END AS security_id, CASE WHEN n = 1 THEN episode_id END AS episode_id,
    CASE WHEN pair <> 'both' THEN 'missing_adjustment_pair' WHEN n > 1 THEN 'ambiguous_episode_overlap' WHEN n = 1 AND fine THEN 'mapped' WHEN n = 1 THEN 'identity_quarantine' ELSE 'outside_symbol_episode' END AS identity_status
  FROM p JOIN h ON p.symbol = h.symbol AND p.date = h.date)"""
)


def _sides(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    return view(spark, d, "v_bars_raw"), view(spark, d, "v_bars_split")


def _mapped(spark: SparkSession, d: str) -> DataFrame:
    return B.mapped_bars(B.paired(*_sides(spark, d)), view(spark, d, "v_episodes"), None, FLOOR)


_BAR_COLUMNS = "symbol date security_id episode_id identity_status raw_close split_adjusted_close".split()


@query(_PAIRS + " SELECT pair, count(*) AS bars, CAST(sum(raw_volume) AS DOUBLE) AS raw_volume, CAST(sum(split_adjusted_volume) AS DOUBLE) AS split_volume FROM p GROUP BY 1", "v_bars_raw", "v_bars_split")
def bars_pair(spark: SparkSession, d: str) -> DataFrame:
    pairs = B.paired(*_sides(spark, d))
    return pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("bars"), F.sum("raw_volume").alias("raw_volume"), F.sum("split_adjusted_volume").alias("split_volume"))


@query(_MAPPED + " SELECT identity_status, count(*) AS bars FROM m GROUP BY 1", *_BAR_VIEWS)
def bars_mapped(spark: SparkSession, d: str) -> DataFrame:
    return _mapped(spark, d).groupBy("identity_status").agg(F.count(F.lit(1)).alias("bars"))


@query(_MAPPED + f" SELECT {', '.join(_BAR_COLUMNS)} FROM m WHERE identity_status = 'mapped'", *_BAR_VIEWS)
def bars_safe(spark: SparkSession, d: str) -> DataFrame:
    return B.safe(_mapped(spark, d)).select(*_BAR_COLUMNS)


@query(_MAPPED + f" SELECT {', '.join(_BAR_COLUMNS)} FROM m WHERE identity_status <> 'mapped'", *_BAR_VIEWS)
def bars_quarantine(spark: SparkSession, d: str) -> DataFrame:
    return B.quarantined(_mapped(spark, d)).select(*_BAR_COLUMNS)


@query(
    _MAPPED
    + """ SELECT identity_status, count(*) AS bars FROM (SELECT CASE WHEN pair <> 'both' THEN 'missing_adjustment_pair' WHEN CAST(substr(symbol, 2) AS BIGINT) % 10 = 3 THEN 'unexpected_returned_symbol' ELSE identity_status END AS identity_status FROM m) GROUP BY 1""",
    *_BAR_VIEWS,
)
def bars_unexpected(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "part").filter("p_partkey % 10 <> 3").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"))
    mapped = B.mapped_bars(B.paired(*_sides(spark, d)), view(spark, d, "v_episodes"), asked, FLOOR)
    return mapped.groupBy("identity_status").agg(F.count(F.lit(1)).alias("bars"))


_METRICS = """count(*) AS row_count, count(DISTINCT symbol) AS symbol_count, CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date,
  CAST(count_if(copies > 1) AS BIGINT) AS duplicate_key_count, count_if(raw_close IS NULL OR split_adjusted_close IS NULL) AS missing_adjustment_pair_count,
  count_if(abs(raw_close - split_adjusted_close) > 1e-9) AS split_adjustment_difference_count, count(DISTINCT security_id) AS security_id_count"""


@query(_MAPPED + f" SELECT {_METRICS} FROM m", *_BAR_VIEWS)
def bars_metrics(spark: SparkSession, d: str) -> DataFrame:
    return B.bar_metrics(_mapped(spark, d))


@query(
    _MAPPED
    + f""", g AS (SELECT {_METRICS}, (SELECT count(*) FROM m WHERE identity_status <> 'mapped') AS quarantine_row_count FROM m WHERE identity_status = 'mapped')
 SELECT *, row_count > 0 AND missing_adjustment_pair_count = 0 AND split_adjustment_difference_count > 0 AND quarantine_row_count > 0 AS pilot_passed FROM g""",
    *_BAR_VIEWS,
)
def pilot_gate(spark: SparkSession, d: str) -> DataFrame:
    return B.mapped_gate(_mapped(spark, d))


@query("""
SELECT symbol, date, close FROM (SELECT 'P' || CAST(l_partkey % 500 AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, l_extendedprice AS close,
  row_number() OVER (PARTITION BY l_partkey % 500, CAST(l_shipdate AS DATE) ORDER BY l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1""")
def bars_one_per_day(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "lineitem").select(F.concat(F.lit("P"), (F.col("l_partkey") % 500).cast("string")).alias("symbol"), F.col("l_shipdate").cast("date").alias("date"), F.col("l_extendedprice").alias("close"), F.col("l_orderkey").alias("page_no"), F.col("l_linenumber").alias("pos"))
    return B.one_bar_per_day(rows)


@query("""
WITH s AS (SELECT DISTINCT 'P' || CAST(l_partkey AS VARCHAR) AS symbol FROM lineitem),
x AS (SELECT DISTINCT 'P' || CAST(o_custkey AS VARCHAR) AS symbol FROM orders WHERE o_orderkey % 8 = 0)
SELECT s.symbol, CASE WHEN x.symbol IS NULL THEN DATE '2001-10-25' ELSE DATE '1996-01-01' END AS start_date FROM s LEFT JOIN x ON s.symbol = x.symbol""")
def update_plan(spark: SparkSession, d: str) -> DataFrame:
    symbols = table(spark, d, "lineitem").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"))
    pending = table(spark, d, "orders").filter("o_orderkey % 8 = 0").select(F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("symbol"))
    return B.update_plan(symbols, dt.date(2001, 11, 1), pending, None, 7, FLOOR)


@query("""
, n AS (SELECT symbol, date, raw_close + 1 AS raw_close FROM v_bars_raw WHERE CAST(substr(symbol, 2) AS BIGINT) % 5 = 0 AND date >= DATE '2000-01-01')
SELECT symbol, date, raw_close FROM v_bars_raw WHERE NOT (CAST(substr(symbol, 2) AS BIGINT) % 5 = 0 AND date >= DATE '2000-01-01') UNION ALL SELECT * FROM n""", "v_bars_raw")
def range_replace(spark: SparkSession, d: str) -> DataFrame:
    old = view(spark, d, "v_bars_raw").select("symbol", "date", "raw_close")
    mine = "CAST(substr(symbol, 2) AS BIGINT) % 5 = 0"
    plan = old.filter(mine).select("symbol").distinct().withColumn("start_date", F.lit(dt.date(2000, 1, 1)))
    fresh = old.filter(f"{mine} AND date >= DATE '2000-01-01'").withColumn("raw_close", F.col("raw_close") + 1)
    return B.replaced(old, fresh, plan)


@query("""
SELECT a.provider_event_id, a.primary_symbol AS symbol FROM v_actions a
WHERE CAST(a.provider_event_id AS BIGINT) % 8 = 0 AND CAST(a.provider_event_id AS BIGINT) % 24 <> 0""", "v_actions")
def pending_splits(spark: SparkSession, d: str) -> DataFrame:
    actions = view(spark, d, "v_actions")
    ids = table(spark, d, "orders").select("o_orderkey", F.col("o_orderkey").cast("string").alias("provider_event_id"))
    return B.pending_splits(ids.filter("o_orderkey % 8 = 0"), ids.filter("o_orderkey % 24 = 0"), actions)


@query("SELECT symbol, (row_number() OVER (ORDER BY symbol) - 1) // 50 AS batch_no FROM (SELECT DISTINCT p_brand || '-' || p_size AS symbol FROM part)")
def symbol_batches(spark: SparkSession, d: str) -> DataFrame:
    return B.batches(table(spark, d, "part").select(F.concat("p_brand", F.lit("-"), F.col("p_size").cast("string")).alias("symbol")), 50)


# ---- security master

_LISTED = r"""
, l AS (SELECT upper(trim(ticker)) AS symbol, name AS company_name, CASE WHEN cik IS NULL THEN NULL ELSE lpad(regexp_replace(cik, '[^0-9]', '', 'g'), 10, '0') END AS cik,
    composite_figi, share_class_figi, type AS instrument_type, market, locale, upper(currency_name) AS currency, primary_exchange, active,
    TRY_CAST(delisted_utc AS DATE) AS delisted_date, CAST(last_updated_utc AS DATE) AS updated, page_pos FROM v_listings)
, i AS (SELECT *, CASE WHEN share_class_figi IS NOT NULL THEN 'share_class_figi:' || share_class_figi WHEN composite_figi IS NOT NULL THEN 'composite_figi:' || composite_figi
    WHEN cik IS NOT NULL THEN 'cik_symbol:' || cik || ':' || symbol ELSE 'massive_fallback:' || substr(sha256(coalesce(primary_exchange, '') || '|' || symbol || '|' || coalesce(company_name, '')), 1, 20) END AS security_id FROM l)
, u AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY security_id, symbol ORDER BY updated DESC NULLS LAST, active DESC, page_pos DESC) AS n FROM i) WHERE n = 1)
, a AS (SELECT id AS asset_id, symbol AS asset_symbol, status AS asset_status, tradable FROM v_assets)
, c AS (SELECT 'P' || CAST(s_suppkey AS VARCHAR) AS symbol FROM supplier WHERE s_suppkey % 3 = 0)
, f AS (SELECT u.*, asset_id, asset_symbol, asset_status, tradable, c.symbol IS NOT NULL AS reit, CAST(regexp_extract(u.symbol, '[0-9]+') AS BIGINT) % 41 = 0 AS sp_reit,
    min(security_id) OVER (PARTITION BY u.symbol) <> max(security_id) OVER (PARTITION BY u.symbol) AS conflict,
    CASE WHEN regexp_matches(company_name, '(?i)\bBUSINESS DEVELOPMENT (COMPANY|CORPORATION)\b|\bBDC\b') THEN 'business_development_company' WHEN regexp_matches(company_name, '(?i)\bL\.?P\.?\b|\bLIMITED PARTNERSHIP\b') THEN 'limited_partnership' END AS structure,
    active OR delisted_date IS NULL OR delisted_date >= DATE '1996-01-01' AS in_window
  FROM u LEFT JOIN a ON u.symbol = a.asset_symbol LEFT JOIN c ON u.symbol = c.symbol)
, s AS (SELECT *, nullif(array_to_string(list_filter([CASE WHEN instrument_type <> 'CS' THEN 'not_common_stock' END, CASE WHEN currency <> 'USD' THEN 'non_usd_currency' END,
    CASE WHEN primary_exchange IS NULL OR primary_exchange NOT IN ('ARCX', 'BATS', 'IEXG', 'LTSE', 'XASE', 'XNAS', 'XNYS') THEN 'ineligible_exchange' END,
    CASE WHEN reit OR sp_reit THEN 'known_reit_or_reoc' END, structure, CASE WHEN NOT in_window THEN 'delisted_before_history_window' END,
    CASE WHEN conflict THEN 'ambiguous_reused_symbol' END], lambda x: x IS NOT NULL), ';'), '') AS exclusion_reason FROM f)"""
_MASTER_VIEWS = ("v_listings", "v_assets")


def _listings(spark: SparkSession, d: str) -> DataFrame:
    return view(spark, d, "v_listings").withColumnRenamed("page_pos", "pos").withColumn("page_no", F.lit(0))


def _master(spark: SparkSession, d: str) -> DataFrame:
    assets = P.normalised_assets(view(spark, d, "v_assets"))
    reits = table(spark, d, "supplier").filter("s_suppkey % 3 = 0").select(F.concat(F.lit("P"), F.col("s_suppkey").cast("string")).alias("symbol"))
    sectors = table(spark, d, "part").select(F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("symbol"), F.lit("Any").alias("sector"), F.when(F.expr("p_partkey % 41 = 0"), "Office REIT").otherwise("Industrial REITs").alias("industry"))
    return I.security_master(_listings(spark, d), assets, SNAPSHOT, reits, sectors.withColumn("symbol_join_key", X.join_key("symbol")), FLOOR)


@query(
    _LISTED
    + """ SELECT security_id, symbol, company_name, cik, currency, active, delisted_date, asset_id AS alpaca_asset_id, tradable AS alpaca_tradable, structure AS structure_exclusion_reason,
  CASE WHEN asset_id IS NULL THEN 'no_current_asset' ELSE 'exact_symbol' END AS alpaca_asset_match_status, in_window AS in_price_history_window, conflict AS symbol_identity_conflict,
  reit OR sp_reit AS is_known_reit, exclusion_reason IS NULL AS is_price_coverage_eligible, exclusion_reason FROM s""",
    *_MASTER_VIEWS,
)
def security_master(spark: SparkSession, d: str) -> DataFrame:
    return _master(spark, d).select(
        *"security_id symbol company_name cik currency active delisted_date alpaca_asset_id alpaca_tradable structure_exclusion_reason alpaca_asset_match_status in_price_history_window symbol_identity_conflict is_known_reit is_price_coverage_eligible exclusion_reason".split()
    )


@query(
    _LISTED
    + """ SELECT security_id || '|' || symbol || '|pending' AS episode_id, coalesce(asset_symbol, symbol) AS provider_symbol, CASE WHEN active THEN symbol END AS current_symbol,
  delisted_date AS symbol_valid_to, 'pending_episode_enrichment' AS episode_status FROM s WHERE exclusion_reason IS NULL""",
    *_MASTER_VIEWS,
)
def tickers_pending(spark: SparkSession, d: str) -> DataFrame:
    return I.pending_tickers(_master(spark, d)).select("episode_id", "provider_symbol", "current_symbol", "symbol_valid_to", "episode_status")


@query(_LISTED + " SELECT security_id, symbol, exclusion_reason FROM s WHERE exclusion_reason IS NOT NULL", *_MASTER_VIEWS)
def exclusions(spark: SparkSession, d: str) -> DataFrame:
    return I.exclusions(_master(spark, d)).select("security_id", "symbol", "exclusion_reason")


@query(_LISTED + " SELECT reason, count(*) AS rows FROM (SELECT unnest(string_split(exclusion_reason, ';')) AS reason FROM s WHERE exclusion_reason IS NOT NULL) GROUP BY 1", *_MASTER_VIEWS)
def exclusion_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.reason_counts(I.exclusions(_master(spark, d)), "exclusion_reason")


@query(_LISTED + " SELECT symbol, count(DISTINCT security_id) AS securities FROM s WHERE conflict GROUP BY 1", *_MASTER_VIEWS)
def symbol_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return _master(spark, d).filter("symbol_identity_conflict").groupBy("symbol").agg(F.count_distinct("security_id").alias("securities"))


@query(
    _LISTED
    + """ SELECT count_if(active) AS active_count, count_if(NOT active) AS inactive_count, count_if(exclusion_reason IS NULL) AS price_coverage_eligible_count,
  count_if(conflict) AS identity_conflict_count, count_if(reit OR sp_reit) AS known_reit_count FROM s""",
    *_MASTER_VIEWS,
)
def master_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.security_master_counts(_master(spark, d))


@query("""
SELECT symbol_join_key, alpaca_asset_id FROM (SELECT upper(p_brand) || '-X' AS symbol_join_key, 'asset-' || CAST(p_partkey AS VARCHAR) AS alpaca_asset_id,
  row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN p_partkey % 4 = 0 THEN 'inactive' ELSE 'active' END, 'asset-' || CAST(p_partkey AS VARCHAR)) AS n FROM part) WHERE n = 1""")
def asset_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "part").select(F.concat(F.lit("asset-"), F.col("p_partkey").cast("string")).alias("id"), F.concat("p_brand", F.lit(".x")).alias("symbol"), F.lit("nyse").alias("exchange"), F.expr("CASE WHEN p_partkey % 4 = 0 THEN 'Inactive' ELSE 'ACTIVE' END").alias("status"), F.lit("true").alias("tradable"))
    return I.one_asset_per_key(P.normalised_assets(rows)).select(F.upper("symbol_join_key").alias("symbol_join_key"), "alpaca_asset_id")


# ---- symbol episodes

_WALK = """
, roots AS (SELECT security_id, symbol AS cursor, DATE '2002-01-02' AS boundary FROM v_master)
, ev AS (SELECT event_id AS event, old_symbol AS old, new_symbol AS new, process_date AS day FROM v_name_changes WHERE old_symbol <> new_symbol AND process_date < DATE '2002-01-02')
, st AS (SELECT DISTINCT cursor, boundary FROM (SELECT cursor, boundary FROM roots UNION ALL SELECT old, day FROM ev))
, steps AS (SELECT st.cursor, st.boundary, event, old, day FROM st JOIN ev ON st.cursor = ev.new AND ev.day < st.boundary)
, de AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cursor, boundary ORDER BY day DESC, event) AS n FROM steps) WHERE n = 1)
, pe AS (SELECT security_id, cursor, boundary, min(old) AS p_old, min(day) AS p_day FROM steps JOIN (SELECT DISTINCT security_id, symbol FROM v_master) o ON steps.old = o.symbol GROUP BY 1, 2, 3 HAVING count(*) = 1)
, walk AS (
  SELECT security_id, 0 AS step, CAST(NULL AS VARCHAR) AS cursor, CAST(NULL AS VARCHAR) AS old, CAST(NULL AS DATE) AS day, cursor AS nc, boundary AS nb, [cursor] AS seen, FALSE AS stopped FROM roots
  UNION ALL
  SELECT w.security_id, w.step + 1, w.nc, coalesce(p_old, de.old), coalesce(p_day, de.day), coalesce(p_old, de.old), coalesce(p_day, de.day), list_append(w.seen, coalesce(p_old, de.old)), list_contains(w.seen, coalesce(p_old, de.old))
  FROM walk w JOIN de ON de.cursor = w.nc AND de.boundary = w.nb LEFT JOIN pe ON pe.security_id = w.security_id AND pe.cursor = w.nc AND pe.boundary = w.nb
  WHERE NOT w.stopped)"""
_EPISODES = (
    _WALK
    + """
, cs AS (SELECT security_id, cursor AS symbol, arg_max(day, step) AS chain_from FROM walk WHERE step > 0 GROUP BY 1, 2)
, ce AS (SELECT security_id, old AS symbol, arg_max(day, step) - 1 AS chain_to FROM walk WHERE step > 0 GROUP BY 1, 2)
, sy AS (SELECT security_id, symbol FROM v_master UNION SELECT security_id, symbol FROM cs UNION SELECT security_id, symbol FROM ce)
, b AS (SELECT sy.security_id, sy.symbol, r.symbol AS terminal, r.active AS single, m.security_id IS NOT NULL AS has, r.company_name,
    r.is_price_coverage_eligible AS eligible, chain_from, coalesce(CAST(chain_to AS DATE), CASE WHEN NOT (r.active AND sy.symbol = r.symbol) THEN m.delisted_date - 1 END) AS known_to
  FROM sy JOIN v_master r ON r.security_id = sy.security_id LEFT JOIN v_master m ON m.security_id = sy.security_id AND m.symbol = sy.symbol
  LEFT JOIN cs ON cs.security_id = sy.security_id AND cs.symbol = sy.symbol LEFT JOIN ce ON ce.security_id = sy.security_id AND ce.symbol = sy.symbol)
, fi AS (SELECT *, row_number() OVER w AS place, coalesce(chain_from, CASE WHEN row_number() OVER w = 1 THEN DATE '1996-01-01' ELSE CAST(lag(known_to) OVER w + 1 AS DATE) END) AS vf,
    CAST(coalesce(known_to, CAST(lead(chain_from) OVER w - 1 AS DATE)) AS DATE) AS vt
  FROM b WINDOW w AS (PARTITION BY security_id ORDER BY known_to NULLS LAST, chain_from NULLS LAST, symbol))
, es AS (SELECT security_id || '|' || symbol || '|' || coalesce(CAST(vf AS VARCHAR), 'unknown') AS episode_id, security_id, symbol, vf AS symbol_valid_from, vt AS symbol_valid_to,
    CASE WHEN vf IS NULL OR coalesce(vf > vt, FALSE) THEN 'unresolved' WHEN single AND symbol = terminal THEN 'current' ELSE 'bounded' END AS status0,
    eligible, eligible AND NOT (vf IS NULL OR coalesce(vf > vt, FALSE)) AS fine0 FROM fi)
, ep AS (SELECT es.*, EXISTS (SELECT 1 FROM es o WHERE o.symbol = es.symbol AND o.security_id <> es.security_id AND (es.symbol_valid_from IS NULL OR o.symbol_valid_from IS NULL
    OR ((o.symbol_valid_to IS NULL OR es.symbol_valid_from <= o.symbol_valid_to) AND (es.symbol_valid_to IS NULL OR o.symbol_valid_from <= es.symbol_valid_to)))) AS hit FROM es)"""
)
_EPISODE_VIEWS = ("v_master", "v_name_changes")


def _recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def _changes(spark: SparkSession, d: str) -> DataFrame:
    return E.one_per_event(P.normalised_name_changes(view(spark, d, "v_name_changes")))


def _episodes(spark: SparkSession, d: str) -> DataFrame:
    return E.symbol_episodes(view(spark, d, "v_master"), _changes(spark, d), SNAPSHOT, FLOOR)


@query("SELECT event_id, process_date, old_symbol, new_symbol FROM v_name_changes WHERE old_symbol <> new_symbol", "v_name_changes")
def name_changes(spark: SparkSession, d: str) -> DataFrame:
    return _changes(spark, d).select("event_id", "process_date", "old_symbol", "new_symbol")


@query("""
SELECT event_id, process_date, old_symbol FROM (SELECT CAST(o_custkey AS VARCHAR) AS event_id, CAST(o_orderdate AS DATE) AS process_date, 'A' || CAST(o_orderkey AS VARCHAR) AS old_symbol,
  row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, 'A' || CAST(o_orderkey AS VARCHAR) DESC) AS n FROM orders) WHERE n = 1""")
def name_change_dedup(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders").select(F.col("o_custkey").cast("string").alias("event_id"), F.col("o_orderdate").cast("date").cast("string").alias("process_date"), F.concat(F.lit("a"), F.col("o_orderkey").cast("string")).alias("old_symbol"), F.lit("zz").alias("new_symbol"))
    return E.one_per_event(P.normalised_name_changes(rows)).select("event_id", "process_date", "old_symbol")


@query(_WALK + " SELECT security_id, step, cursor, old, day FROM walk WHERE step > 0", *_EPISODE_VIEWS)
def episode_chain(spark: SparkSession, d: str) -> DataFrame:
    return E.chains(view(spark, d, "v_master"), _changes(spark, d), SNAPSHOT)


@query(
    _EPISODES + " SELECT episode_id, security_id, symbol, symbol_valid_from, symbol_valid_to, CASE WHEN hit THEN 'unresolved' ELSE status0 END AS episode_status, fine0 AND NOT hit AS is_episode_mapping_eligible FROM ep",
    *_EPISODE_VIEWS,
)
def symbol_episodes(spark: SparkSession, d: str) -> DataFrame:
    return _episodes(spark, d).select("episode_id", "security_id", "symbol", "symbol_valid_from", "symbol_valid_to", "episode_status", "is_episode_mapping_eligible")


@query(
    _EPISODES + " SELECT count_if(hit OR status0 = 'unresolved') AS unresolved_episode_count, count_if(NOT hit AND status0 = 'current') AS resolved_current_count, count_if(NOT (fine0 AND NOT hit)) AS unmappable_episode_count, count_if(eligible AND NOT (fine0 AND NOT hit)) AS mapping_quarantine_episode_count FROM ep",
    *_EPISODE_VIEWS,
)
def episode_counts(spark: SparkSession, d: str) -> DataFrame:
    counts = M.episode_counts(_episodes(spark, d), resolved_current_count="episode_status = 'current'")
    return counts.select("unresolved_episode_count", "unmappable_episode_count", "mapping_quarantine_episode_count", "resolved_current_count")


@query("""
SELECT a.episode_id, EXISTS (SELECT 1 FROM v_episodes b WHERE a.symbol = b.symbol AND a.security_id <> b.security_id AND (a.symbol_valid_from IS NULL OR b.symbol_valid_from IS NULL
  OR ((b.symbol_valid_to IS NULL OR a.symbol_valid_from <= b.symbol_valid_to) AND (a.symbol_valid_to IS NULL OR b.symbol_valid_from <= a.symbol_valid_to)))) AS overlaps FROM v_episodes a""", "v_episodes")
def episode_overlaps(spark: SparkSession, d: str) -> DataFrame:
    marked = E.mark_overlaps(view(spark, d, "v_episodes").withColumn("episode_status", F.lit("bounded")))
    return marked.select("episode_id", (F.col("episode_status") == "unresolved").alias("overlaps"))


@query(
    _EPISODES
    + """ SELECT ep.episode_id, ep.symbol AS provider_symbol, coalesce(m.industry, r.industry) AS industry, m.alpaca_asset_id, CASE WHEN m.security_id IS NOT NULL THEN m.is_known_reit ELSE r.is_known_reit END AS is_known_reit
  FROM ep JOIN v_master r ON r.security_id = ep.security_id LEFT JOIN v_master m ON m.security_id = ep.security_id AND m.symbol = ep.symbol WHERE ep.eligible""",
    *_EPISODE_VIEWS,
)
def episode_tickers(spark: SparkSession, d: str) -> DataFrame:
    return E.episode_tickers(_episodes(spark, d), view(spark, d, "v_master")).select("episode_id", "provider_symbol", "industry", "alpaca_asset_id", "is_known_reit")


for _name in ("episode_chain", "symbol_episodes", "episode_counts", "episode_tickers"):
    ORACLE_SQL[_name] = _recursive(ORACLE_SQL[_name])


# ---- corporate actions

_EVENTS = """
, ev AS (SELECT *, coalesce(effective_date, ex_date, process_date) AS event_date,
    coalesce(effective_date, ex_date, process_date) - CASE WHEN action_type IN ('name_change', 'cash_merger', 'unit_split') THEN 1 ELSE 0 END AS match_date FROM v_actions)
, mt AS (SELECT ev.provider_event_id, count(e.symbol) AS n, count_if(ok) AS dated, count(DISTINCT CASE WHEN ok THEN security_id END) AS secs, min(CASE WHEN ok THEN security_id END) AS sec, count_if(ok AND NOT is_episode_mapping_eligible) AS unfit
  FROM ev LEFT JOIN (SELECT * FROM v_episodes) e ON ev.primary_symbol = e.symbol,
  LATERAL (SELECT e.symbol IS NOT NULL AND (e.symbol_valid_from IS NULL OR e.symbol_valid_from <= ev.match_date) AND (e.symbol_valid_to IS NULL OR e.symbol_valid_to >= ev.match_date) AS ok) k GROUP BY 1)
, ma AS (SELECT ev.*, CASE WHEN primary_symbol IS NULL THEN 'not_applicable' WHEN n = 0 THEN 'unmatched_symbol' WHEN dated = 0 THEN 'unmatched_date' WHEN secs <> 1 THEN 'ambiguous' WHEN unfit > 0 THEN 'identity_quarantine' ELSE 'matched' END AS identity_match_status, sec
  FROM ev JOIN mt ON ev.provider_event_id = mt.provider_event_id)"""


def _actions(spark: SparkSession, d: str) -> DataFrame:
    a = view(spark, d, "v_actions").withColumn("event_date", X.event_date("effective_date", "ex_date", F.lit(None).cast("date"), "process_date"))
    return a.withColumn("match_date", X.match_date("action_type", "event_date"))


@query(_EVENTS + " SELECT provider_event_id, action_type, identity_match_status, CASE WHEN identity_match_status = 'matched' THEN sec END AS security_id FROM ma", "v_actions", "v_episodes")
def identity_match(spark: SparkSession, d: str) -> DataFrame:
    found = A.matched_identity(_actions(spark, d), view(spark, d, "v_episodes"), "primary_symbol", "match_date", "security_id", "identity_match_status")
    return found.select("provider_event_id", "action_type", "identity_match_status", "security_id")


@query(_EVENTS + " SELECT action_type, count(*) AS events, count_if(identity_match_status = 'matched') AS matched, count_if(identity_match_status <> 'matched') AS unmatched FROM ma GROUP BY 1", "v_actions", "v_episodes")
def action_counts(spark: SparkSession, d: str) -> DataFrame:
    return M.action_counts(A.matched_identity(_actions(spark, d), view(spark, d, "v_episodes"), "primary_symbol", "match_date", "security_id", "identity_match_status"))


def _action_rows(spark: SparkSession, d: str) -> DataFrame:
    """Landed rows: the view as provider JSON, every third event landed twice with a later process date."""
    a = view(spark, d, "v_actions").withColumn("k", F.col("provider_event_id").cast("long"))
    own = {
        "id": "provider_event_id", "process_date": "process_date", "effective_date": "effective_date", "ex_date": "ex_date", "symbol": "primary_symbol", "old_symbol": "primary_symbol",
        "acquiree_symbol": "primary_symbol", "source_symbol": "primary_symbol", "new_symbol": "related_symbol", "acquirer_symbol": "related_symbol", "rate": "rate",
    }
    twice = a.unionByName(a.filter("k % 3 = 0").withColumn("process_date", F.date_add("process_date", 1)))
    raw = F.to_json(F.struct(*[F.col(c).cast("string").alias(n) for n, c in own.items()]))
    return twice.select(F.col("k").alias("page_no"), F.lit(0).alias("pos"), "action_type", raw.alias("raw"))


@query(
    """
SELECT provider_event_id, action_type, process_date + CASE WHEN CAST(provider_event_id AS BIGINT) % 3 = 0 THEN 1 ELSE 0 END AS process_date, primary_symbol,
  related_symbol, rate, action_type IN ('forward_split', 'reverse_split', 'unit_split') AS requires_split_history_refresh FROM v_actions""",
    "v_actions",
)
def actions_norm(spark: SparkSession, d: str) -> DataFrame:
    out = A.corporate_actions(_action_rows(spark, d), view(spark, d, "v_episodes"), SNAPSHOT)
    return out.select("provider_event_id", "action_type", "process_date", "primary_symbol", "related_symbol", "rate", "requires_split_history_refresh")


def _two_versions(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """A published action table, and a refresh of its last part in which some rates changed and some events are gone."""
    a = view(spark, d, "v_actions").withColumn("k", F.col("provider_event_id").cast("long")).withColumn("requires_split_history_refresh", X.is_split("action_type"))
    hashed = lambda df: df.withColumn("raw_payload_sha256", X.sha256(F.concat_ws("|", "provider_event_id", "rate")))
    fresh = a.filter("process_date >= DATE '2001-01-01' AND k % 7 <> 0").withColumn("rate", F.when(F.expr("k % 5 = 0"), F.concat(F.lit("1"), "rate")).otherwise(F.col("rate")))
    return hashed(a), hashed(fresh)


@query(
    """
SELECT provider_event_id, action_type, process_date, CASE WHEN process_date >= DATE '2001-01-01' AND CAST(provider_event_id AS BIGINT) % 5 = 0 THEN '1' || rate ELSE rate END AS rate
FROM v_actions WHERE process_date < DATE '2001-01-01' OR CAST(provider_event_id AS BIGINT) % 7 <> 0""",
    "v_actions",
)
def actions_merge(spark: SparkSession, d: str) -> DataFrame:
    old, new = _two_versions(spark, d)
    return A.merged(old, new, dt.date(2001, 1, 1)).select("provider_event_id", "action_type", "process_date", "rate")


@query("SELECT provider_event_id FROM v_actions WHERE process_date >= DATE '2001-01-01' AND CAST(provider_event_id AS BIGINT) % 7 <> 0 AND CAST(provider_event_id AS BIGINT) % 5 = 0 AND action_type IN ('forward_split', 'reverse_split', 'unit_split')", "v_actions")
def changed_splits(spark: SparkSession, d: str) -> DataFrame:
    return A.changed_splits(*_two_versions(spark, d))


@query("SELECT greatest(DATE '1996-01-01', least(DATE '2001-12-31', CAST(max(CAST(o_orderdate AS DATE)) AS DATE)) - 30)::DATE AS refresh_start, count(*) AS events FROM orders")
def refresh_window(spark: SparkSession, d: str) -> DataFrame:
    a = view(spark, d, "v_actions")
    start = A.refresh_start(a, dt.date(2001, 12, 31), 30, FLOOR)
    return a.agg(F.lit(start).alias("refresh_start"), F.count(F.lit(1)).alias("events"))


@query("SELECT event_id, sha256('{\"a\":\"' || event_type || '\",\"z\":' || replace(props, ' ', '') || '}') AS digest FROM events")
def canonical_payloads(spark: SparkSession, d: str) -> DataFrame:
    raw = F.concat(F.lit('{ "z": '), "props", F.lit(', "a": "'), "event_type", F.lit('" }'))
    return table(spark, d, "events").select("event_id", X.sha256(X.canonical_json(raw)).alias("digest"))


@query(
    """
SELECT l_orderkey, l_linenumber, sha256('{"a":{"c":[' || l_linenumber || ',' || l_discount::DOUBLE || '],"d":' || l_extendedprice::DOUBLE || '},"z":' || l_quantity::DOUBLE || ',"zz":1' || l_orderkey || '00000000000000000001,"ü":"1.0"}') AS digest FROM lineitem"""
)
def payload_hashes(spark: SparkSession, d: str) -> DataFrame:
    """Payloads whose numbers are spelled with spare digits and exponents, and whole numbers beyond 64 bits."""
    raw = F.concat(F.lit('{ "z": '), F.col("l_quantity").cast("decimal(15,3)"), F.lit(', "ü": "1.0", "zz": 1'), "l_orderkey", F.lit('00000000000000000001, "a" : {"d":'), F.col("l_extendedprice").cast("decimal(15,2)"), F.lit('0e0, "c": ['), "l_linenumber", F.lit(", "), F.col("l_discount").cast("decimal(15,2)"), F.lit("00]}}"))
    return table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", X.sha256(X.canonical_json(raw)).alias("digest"))


# ---- coverage audit

_CASES = (
    ("P1", ["active", "forward_split"], ["full_window", "event_both_sides"], "forward_split", dt.date(1998, 6, 1)),
    ("P2", ["active", "reverse_split"], ["full_window", "event_both_sides"], "reverse_split", dt.date(1999, 6, 1)),
    ("P3", ["acquisition"], ["expected_end"], "acquisition", None),
    ("P6", ["acquisition"], ["expected_end"], "acquisition", None),
)
_AUDIT_END = dt.date(2001, 10, 31)
_AUDIT_MASTER = """
, am AS (SELECT 'S' || CAST(p_partkey AS VARCHAR) AS security_id, 'P' || CAST(p_partkey % 1900 AS VARCHAR) AS symbol, p_name AS company_name, p_partkey % 3 <> 0 AS active,
    CASE WHEN p_partkey % 3 = 0 THEN CAST(DATE '1996-06-01' + CAST(p_partkey % 1900 AS INT) AS DATE) END AS delisted_date, p_partkey % 8 <> 0 AS has_alpaca_asset,
    count(*) OVER (PARTITION BY p_partkey % 1900) > 1 AS symbol_identity_conflict, p_partkey % 5 <> 0 AS is_price_coverage_eligible FROM part)"""
_SAMPLE = (
    _AUDIT_MASTER
    + """
, gone AS (SELECT * FROM am WHERE NOT active AND is_price_coverage_eligible AND NOT symbol_identity_conflict AND delisted_date IS NOT NULL)
, parts AS (
  SELECT security_id, am.symbol, 0 AS kind, place, c.categories, c.roles, c.event_type, coalesce(c.event_date, delisted_date) AS event_date
    FROM am JOIN (VALUES ('P1', ['active', 'forward_split'], ['full_window', 'event_both_sides'], 'forward_split', DATE '1998-06-01', 0), ('P2', ['active', 'reverse_split'], ['full_window', 'event_both_sides'], 'reverse_split', DATE '1999-06-01', 1),
      ('P3', ['acquisition'], ['expected_end'], 'acquisition', NULL, 2), ('P6', ['acquisition'], ['expected_end'], 'acquisition', NULL, 3)) c(symbol, categories, roles, event_type, event_date, place) ON am.symbol = c.symbol
  UNION ALL SELECT security_id, symbol, 1, 0, ['ticker_change'], ['expected_end'], 'ticker_change', delisted_date FROM am WHERE symbol = 'P9'
  UNION ALL (SELECT security_id, symbol, 2, 0, ['recent_delisting'], ['expected_end'], NULL, delisted_date FROM gone WHERE delisted_date >= DATE '2001-10-31' - 1098 ORDER BY sha256('v1|recent_delisting|' || security_id || '|' || symbol), 1, 2 LIMIT 4)
  UNION ALL (SELECT security_id, symbol, 3, 0, ['older_delisting'], ['expected_end'], NULL, delisted_date FROM gone WHERE delisted_date >= DATE '1996-01-01' AND delisted_date < DATE '2001-10-31' - 1098 ORDER BY sha256('v1|older_delisting|' || security_id || '|' || symbol), 1, 2 LIMIT 4)
  UNION ALL (SELECT security_id, symbol, 4, 0, ['ticker_reuse'], ['ambiguous'], NULL, NULL FROM am WHERE symbol_identity_conflict ORDER BY sha256('v1|ticker_reuse|' || security_id || '|' || symbol), 1, 2 LIMIT 10))
, sa AS (SELECT am.security_id || '|' || am.symbol AS sample_id, am.security_id, am.symbol, am.active, am.delisted_date,
    array_to_string(list_sort(list_distinct(flatten(list(categories)))), ';') AS sample_categories, array_to_string(list_sort(list_distinct(flatten(list(roles)))), ';') AS sample_roles,
    first(event_type ORDER BY kind, place) FILTER (event_type IS NOT NULL) AS known_event_type, CAST(first(event_date ORDER BY kind, place) FILTER (event_date IS NOT NULL) AS DATE) AS known_event_date
  FROM parts JOIN am ON parts.security_id = am.security_id AND parts.symbol = am.symbol GROUP BY ALL)"""
)
_SAMPLE = _SAMPLE.replace("GROUP BY ALL)", "GROUP BY am.security_id, am.symbol, am.active, am.delisted_date)")
_REPORT = (
    _SAMPLE
    + """
, ob AS (SELECT CASE WHEN l_linenumber = 7 THEN 'iex' ELSE 'sip' END AS feed, 'P' || CAST(l_partkey AS VARCHAR) AS symbol, CAST(l_shipdate AS DATE) AS date, CAST(l_quantity AS BIGINT) * CASE WHEN l_linenumber = 7 THEN 1 ELSE 100 END AS volume FROM lineitem)
, sip AS (SELECT symbol, count(*) AS bar_count, min(date) AS first_bar_date, max(date) AS last_bar_date, sum(volume) AS total_volume FROM ob WHERE feed = 'sip' GROUP BY 1)
, ev2 AS (SELECT sa.sample_id, count_if(date < known_event_date) AS pre, count_if(date >= known_event_date) AS post, sum(CASE WHEN date >= DATE '2001-08-02' THEN volume ELSE 0 END) AS recent FROM sa JOIN ob ON ob.symbol = sa.symbol AND feed = 'sip' GROUP BY 1)
, iex AS (SELECT symbol, count(*) AS iex_bars, sum(volume) AS iex_volume FROM ob WHERE feed = 'iex' GROUP BY 1)
, re AS (SELECT sa.*, coalesce(bar_count, 0) AS bar_count, first_bar_date, last_bar_date, CAST(coalesce(total_volume, 0) AS BIGINT) AS total_volume, coalesce(pre, 0) AS pre, coalesce(post, 0) AS post, CAST(coalesce(recent, 0) AS BIGINT) AS recent,
    CAST(coalesce(iex_bars, 0) AS BIGINT) AS iex_bars, CAST(coalesce(iex_volume, 0) AS BIGINT) AS iex_volume, sip.symbol IS NULL AS missing, string_split(sample_roles, ';') AS roles,
    known_event_date - 1 AS expected_end, known_event_date AS expected_start, sa.symbol IN ('P1', 'P2') AS compared
  FROM sa LEFT JOIN sip ON sip.symbol = sa.symbol LEFT JOIN ev2 ON ev2.sample_id = sa.sample_id LEFT JOIN iex ON iex.symbol = sa.symbol)
, ra AS (SELECT *, CASE WHEN iex_volume > 0 THEN round(CAST(recent AS DOUBLE) / iex_volume, 6) END AS ratio FROM re)
, rr AS (SELECT *, list_filter([CASE WHEN missing THEN 'request_error' END, CASE WHEN bar_count = 0 THEN 'no_bars' END, CASE WHEN list_contains(roles, 'ambiguous') THEN 'ambiguous_reused_symbol' END,
    CASE WHEN list_contains(roles, 'full_window') AND first_bar_date > DATE '1996-01-15' OR list_contains(roles, 'expected_start') AND first_bar_date > expected_start + 14 THEN 'truncated_start' END,
    CASE WHEN active AND last_bar_date < DATE '2001-10-24' THEN 'active_history_stale' END, CASE WHEN list_contains(roles, 'expected_end') AND last_bar_date < expected_end - 14 THEN 'truncated_end' END,
    CASE WHEN list_contains(roles, 'event_both_sides') AND bar_count > 0 AND pre = 0 THEN 'missing_pre_event_bars' END, CASE WHEN list_contains(roles, 'event_both_sides') AND bar_count > 0 AND post = 0 THEN 'missing_post_event_bars' END,
    CASE WHEN compared AND iex_bars = 0 THEN 'iex_no_bars' END], lambda x: x IS NOT NULL) AS failures,
  list_filter([CASE WHEN list_contains(roles, 'expected_end') AND last_bar_date > expected_end + 14 THEN 'bars_after_expected_end' END,
    CASE WHEN compared AND iex_bars > 0 AND (ratio IS NULL OR ratio <= 1) THEN 'sip_volume_not_greater_than_iex' END], lambda x: x IS NOT NULL) AS warnings FROM ra)"""
)


def _audit_master(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    k = F.col("p_partkey")
    return table(spark, d, "part").select(
        F.concat(F.lit("S"), k.cast("string")).alias("security_id"),
        F.concat(F.lit("P"), (k % 1900).cast("string")).alias("symbol"),
        F.col("p_name").alias("company_name"),
        (k % 3 != 0).alias("active"),
        F.expr("CASE WHEN p_partkey % 3 = 0 THEN date_add(DATE '1996-06-01', CAST(p_partkey % 1900 AS INT)) END").alias("delisted_date"),
        (k % 8 != 0).alias("has_alpaca_asset"),
        (F.count(F.lit(1)).over(Window.partitionBy(k % 1900)) > 1).alias("symbol_identity_conflict"),
        (k % 5 != 0).alias("is_price_coverage_eligible"),
    )


def _sample(spark: SparkSession, d: str) -> DataFrame:
    return U.audit_sample(_audit_master(spark, d), _AUDIT_END, None, FLOOR, _CASES, (("P9", "P10"),))


def _report(spark: SparkSession, d: str) -> DataFrame:
    k = F.concat(F.lit("P"), F.col("l_partkey").cast("string"))
    feed = F.when(F.col("l_linenumber") == 7, "iex").otherwise("sip")
    volume = F.col("l_quantity").cast("long") * F.when(F.col("l_linenumber") == 7, 1).otherwise(100)
    seen = table(spark, d, "lineitem").select(feed.alias("feed"), k.alias("requested"), k.alias("returned"), F.col("l_shipdate").cast("date").alias("date"), volume.alias("volume"))
    results = seen.groupBy("feed", "requested").agg(F.array_sort(F.collect_set("returned")).alias("returned_symbols"), F.lit(None).cast("string").alias("request_error"))
    return U.coverage_report(_sample(spark, d), seen, results, SNAPSHOT, _AUDIT_END, _AUDIT_END - dt.timedelta(days=U.COMPARISON_DAYS), FLOOR, ("P1", "P2"))


def _plain_with(sql: str) -> str:
    return "WITH " + sql.strip().removeprefix(",").strip()


@query(_plain_with(_SAMPLE + " SELECT sample_id, active, delisted_date, sample_categories, sample_roles, known_event_type, known_event_date FROM sa"))
def audit_sample(spark: SparkSession, d: str) -> DataFrame:
    return _sample(spark, d).select("sample_id", "active", "delisted_date", "sample_categories", "sample_roles", "known_event_type", "known_event_date")


@query(
    _plain_with(
        _REPORT
        + """ SELECT sample_id, bar_count, CAST(first_bar_date AS DATE) AS first_bar_date, CAST(last_bar_date AS DATE) AS last_bar_date, total_volume, CASE WHEN compared THEN ratio END AS sip_to_iex_volume_ratio,
  CASE WHEN len(failures) > 0 THEN 'fail' WHEN len(warnings) > 0 THEN 'warning' ELSE 'pass' END AS audit_status, nullif(array_to_string(list_concat(failures, warnings), ';'), '') AS coverage_reason FROM rr"""
    )
)
def coverage_report(spark: SparkSession, d: str) -> DataFrame:
    return _report(spark, d).select("sample_id", "bar_count", "first_bar_date", "last_bar_date", "total_volume", "sip_to_iex_volume_ratio", "audit_status", "coverage_reason")


@query(
    _plain_with(
        _REPORT
        + """
, de2 AS (SELECT *, list_contains(roles, 'expected_end') AND NOT list_contains(roles, 'ambiguous') AS del, contains(sample_categories, 'ticker_change') AS changed, CAST(NULL AS DATE) AS valid_from FROM rr)
, su AS (SELECT count_if(del AND bar_count > 0 AND NOT list_contains(failures, 'truncated_end')) AS delisted_coverage_count, count_if(del) AS delisted_sample_count, count_if(bar_count > 0) > 0 AS sip_access_verified,
    count_if(compared) > 0 AND count_if(compared AND NOT coalesce(ratio > 1, FALSE)) = 0 AS sip_volume_exceeds_iex, count_if(list_contains(failures, 'returned_under_different_symbol')) > 0 AS symbol_remapping_observed,
    count_if(changed) > 0 AND count_if(changed AND NOT (bar_count > 0 AND valid_from IS NOT NULL AND len(list_filter(list_concat(failures, warnings), lambda x: x <> 'bars_outside_episode')) = 0)) = 0 AS ticker_change_coverage_adequate FROM de2)
, sv AS (SELECT *, CASE WHEN delisted_sample_count > 0 THEN round(CAST(delisted_coverage_count AS DOUBLE) / delisted_sample_count, 6) END AS delisted_coverage_pct FROM su)
, bl AS (SELECT *, list_filter([CASE WHEN NOT sip_access_verified THEN 'sip_access_not_verified' END, CASE WHEN coalesce(delisted_coverage_pct, 0) < 0.8 THEN 'delisted_coverage_below_80_pct' END,
  CASE WHEN NOT sip_volume_exceeds_iex THEN 'sip_volume_not_confirmed_against_iex' END, CASE WHEN symbol_remapping_observed THEN 'symbol_remapping_observed' END, CASE WHEN NOT ticker_change_coverage_adequate THEN 'ticker_change_coverage_inadequate' END], lambda x: x IS NOT NULL) AS b FROM sv)
SELECT * EXCLUDE (b), CASE WHEN len(b) > 0 THEN 'blocked' ELSE 'proceed' END AS backfill_recommendation, CASE WHEN len(b) > 0 THEN array_to_string(b, ';') ELSE 'audit_gate_passed' END AS backfill_recommendation_reason FROM bl"""
    )
)
def coverage_summary(spark: SparkSession, d: str) -> DataFrame:
    return U.coverage_summary(_report(spark, d))


@query(_plain_with(_REPORT + " SELECT CASE WHEN len(failures) > 0 THEN 'fail' WHEN len(warnings) > 0 THEN 'warning' ELSE 'pass' END AS audit_status, count(*) AS rows FROM rr GROUP BY 1"))
def audit_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return U.status_counts(_report(spark, d))


# ---- landed pages


@query("SELECT event_type AS kind, count(*) AS rows, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total FROM events GROUP BY 1")
def json_pages(spark: SparkSession, d: str) -> DataFrame:
    """Events as pages of one `results` array per hour and type, flattened again."""
    entry = F.struct(F.col("event_type").alias("ticker"), F.get_json_object("props", "$.k").alias("name"))
    pages = table(spark, d, "events").groupBy(F.date_trunc("hour", "ts").alias("h"), "event_type").agg(F.collect_list(entry).alias("results"))
    pages = pages.select(F.xxhash64("h", "event_type").alias("page_no"), F.to_json(F.struct("results")).alias("body"))
    rows = P.listing_rows(pages)
    return rows.groupBy(F.col("ticker").alias("kind")).agg(F.count(F.lit(1)).alias("rows"), F.sum(F.col("name").cast("long")).alias("total"))


@query("SELECT symbol, date, CAST(raw_trade_count AS BIGINT) AS raw_trade_count, raw_close FROM v_bars_raw", "v_bars_raw")
def bar_pages(spark: SparkSession, d: str) -> DataFrame:
    """Bars as pages keyed by symbol, scanned again."""
    bar = F.struct(F.concat(F.col("date").cast("string"), F.lit("T05:00:00Z")).alias("t"), F.col("raw_close").alias("c"), F.col("raw_trade_count").alias("n"))
    pages = view(spark, d, "v_bars_raw").groupBy("symbol", F.year("date").alias("y")).agg(F.collect_list(bar).alias("b"))
    pages = pages.select(F.xxhash64("symbol", "y").alias("page_no"), F.to_json(F.struct(F.create_map(F.lower("symbol"), "b").alias("bars"))).alias("body"))
    return P.bar_rows(pages, "raw").select("symbol", "date", "raw_trade_count", "raw_close")


@query("SELECT action_type, count(*) AS rows FROM (SELECT CASE o_orderkey % 3 WHEN 0 THEN 'cash_dividend' WHEN 1 THEN 'forward_split' ELSE 'name_change' END AS action_type FROM orders) GROUP BY 1")
def action_pages(spark: SparkSession, d: str) -> DataFrame:
    """Orders as pages of collections, scanned again."""
    kind = F.element_at(F.array(F.lit("cash_dividends"), F.lit("forward_splits"), F.lit("name_changes")), (F.col("o_orderkey") % 3 + 1).cast("int"))
    entry = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").cast("date").cast("string").alias("process_date"))
    pages = table(spark, d, "orders").groupBy(F.col("o_custkey"), kind.alias("kind")).agg(F.collect_list(entry).alias("v"))
    body = F.to_json(F.struct(F.create_map("kind", "v").alias("corporate_actions")))
    rows = P.action_rows(pages.select(F.xxhash64("o_custkey", "kind").alias("page_no"), body.alias("body")))
    return rows.groupBy("action_type").agg(F.count(F.lit(1)).alias("rows"))


@query("SELECT CASE WHEN l_linenumber < 4 THEN 'sip' ELSE 'iex' END AS feed, 'P' || CAST(l_partkey AS VARCHAR) AS requested, count(*) AS bars, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume FROM lineitem GROUP BY 1, 2")
def audit_pages(spark: SparkSession, d: str) -> DataFrame:
    """All line items as audit envelopes of two feeds, scanned again."""
    bar = F.struct(F.col("l_shipdate").cast("date").cast("string").alias("t"), F.col("l_quantity").cast("long").alias("v"))
    feed = F.when(F.col("l_linenumber") < 4, "sip").otherwise("iex").alias("feed")
    own = table(spark, d, "lineitem").groupBy(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("s"), feed).agg(F.collect_list(bar).alias("b"))
    body = F.to_json(F.struct(F.struct(F.array("s").alias("symbols"), "feed").alias("request"), F.struct(F.create_map("s", "b").alias("bars")).alias("response")))
    observations, _ = P.audit_rows(own.select(F.xxhash64("s", "feed").alias("page_no"), body.alias("body")))
    return observations.groupBy("feed", "requested").agg(F.count(F.lit(1)).alias("bars"), F.sum("volume").alias("volume"))


@query("SELECT CAST(sum(CASE o_orderpriority WHEN '1-URGENT' THEN 1 ELSE 2 END) AS BIGINT) AS request_count FROM (SELECT o_orderpriority, row_number() OVER (PARTITION BY o_custkey, o_orderstatus ORDER BY o_orderdate DESC, o_orderkey DESC) AS n FROM orders) WHERE n = 1")
def landed_page_count(spark: SparkSession, d: str) -> DataFrame:
    m = table(spark, d, "orders").select(F.col("o_custkey").alias("batch_id"), F.col("o_orderstatus").alias("adjustment"), F.struct("o_orderdate", "o_orderkey").alias("snapshot_date"), F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(2).alias("page_count"))
    return P.landed_page_count(m)


@query()
def html_cells(spark: SparkSession, d: str) -> DataFrame:
    """Links of every page's lists as cells (the pages hold no tables)."""
    return H.html_cells(table(spark, d, "pages"), "page_id", "html", tables="ul ol", rows="li", cells="a")


@query("SELECT user_id, count(*) AS events, CAST(sum(floor(value * 100)) AS BIGINT) AS cents FROM events GROUP BY 1")
def stream_ingest(spark: SparkSession, d: str) -> DataFrame:
    """Events through the streaming ingest, a second run finding nothing new; then totals per user."""
    from ..sources.tables import shared_dir

    base = f"{shared_dir(spark)}/ingest-{uuid.uuid4().hex}"
    source = table(spark, d, "events").select("event_id", "user_id", "value")
    source.repartition(4, "event_id").write.parquet(f"{base}/landing")
    for _ in range(2):
        ingest(spark, f"{base}/landing", f"{base}/table", f"{base}/checkpoint", "event_id long, user_id long, value double", file_format="parquet", max_files=2)
    return ingested(spark, f"{base}/table").groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.sum(F.floor(F.col("value") * 100)).alias("cents"))


from . import landed_queries  # noqa: E402, F401  (registers its queries)
