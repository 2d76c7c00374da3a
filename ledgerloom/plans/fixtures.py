"""Market-shaped views over the star-schema tables; the text of each view is the same in Spark and in other SQL engines."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

#: The star-schema dates span 1995 to 2001; jobs over them use this floor and snapshot.
FLOOR = dt.date(1996, 1, 1)
SNAPSHOT = dt.date(2002, 1, 1)

VIEWS = {
    "v_listings": """
SELECT 'P' || CAST(CASE WHEN p_partkey % 50 = 0 AND p_partkey > 0 THEN p_partkey - 1 ELSE p_partkey END AS STRING) AS ticker,
  p_name || CASE WHEN p_partkey % 17 = 0 THEN ' L.P.' WHEN p_partkey % 19 = 0 THEN ' Business Development Company' ELSE ' Inc' END AS name,
  CASE WHEN p_partkey % 23 = 0 THEN 'ADR' ELSE 'CS' END AS type, 'stocks' AS market, 'us' AS locale,
  CASE WHEN p_partkey % 29 = 0 THEN 'cad' WHEN p_partkey % 31 = 0 THEN NULL ELSE 'usd' END AS currency_name,
  CASE p_size % 6 WHEN 0 THEN 'XNAS' WHEN 1 THEN 'XNYS' WHEN 2 THEN 'ARCX' WHEN 3 THEN 'XASE' WHEN 4 THEN 'OTCM' ELSE NULL END AS primary_exchange,
  CASE WHEN p_partkey % 5 = 0 THEN NULL WHEN p_partkey % 7 = 1 AND p_partkey > 1 THEN 'BBG' || CAST(p_partkey - 1 AS STRING) ELSE 'BBG' || CAST(p_partkey AS STRING) END AS share_class_figi,
  CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE 'BBC' || CAST(p_partkey AS STRING) END AS composite_figi,
  CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE 'CIK ' || CAST(p_partkey AS STRING) END AS cik,
  p_partkey % 3 <> 0 AS active,
  CASE WHEN p_partkey % 3 = 0 THEN CAST(DATE '1995-01-01' + CAST(p_partkey % 2400 AS INT) AS STRING) ELSE NULL END AS delisted_utc,
  CAST(DATE '2000-01-01' + CAST(p_partkey % 365 AS INT) AS STRING) AS last_updated_utc,
  p_partkey AS page_pos
FROM part""",
    "v_assets": """
SELECT 'asset-' || CAST(p_partkey AS STRING) AS id, 'P' || CAST(p_partkey AS STRING) AS symbol, 'NASDAQ' AS exchange,
  CASE WHEN p_partkey % 4 = 0 THEN 'inactive' ELSE 'active' END AS status, p_partkey % 6 <> 0 AS tradable
FROM part WHERE p_partkey % 8 <> 0""",
    "v_episodes": """
SELECT 'S' || CAST(p_partkey AS STRING) || '|a' AS episode_id, 'S' || CAST(p_partkey AS STRING) AS security_id,
  'P' || CAST(p_partkey AS STRING) AS symbol, CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE DATE '1996-01-01' + CAST(p_partkey % 700 AS INT) END AS symbol_valid_from,
  CASE WHEN p_partkey % 3 = 0 THEN DATE '1999-01-01' + CAST(p_partkey % 700 AS INT) ELSE NULL END AS symbol_valid_to,
  p_partkey % 11 <> 0 AS is_episode_mapping_eligible
FROM part WHERE p_partkey % 37 <> 0
UNION ALL
SELECT 'T' || CAST(p_partkey AS STRING) || '|b', 'T' || CAST(p_partkey AS STRING), 'P' || CAST(p_partkey AS STRING),
  DATE '1998-01-01', NULL, TRUE
FROM part WHERE p_partkey % 13 = 0""",
    "v_bars_raw": """
SELECT 'P' || CAST(l_partkey AS STRING) AS symbol, CAST(l_shipdate AS DATE) AS date,
  min(floor(l_extendedprice / l_quantity * 100) / 100) AS raw_low, max(floor(l_extendedprice / l_quantity * 100) / 100) AS raw_high,
  max_by(floor(l_extendedprice / l_quantity * 100) / 100, l_orderkey * 10 + l_linenumber) AS raw_close,
  sum(l_quantity) AS raw_volume, count(*) AS raw_trade_count
FROM lineitem WHERE l_linenumber <> 6 GROUP BY 1, 2""",
    "v_bars_split": """
SELECT 'P' || CAST(l_partkey AS STRING) AS symbol, CAST(l_shipdate AS DATE) AS date,
  max_by(floor(l_extendedprice / l_quantity * 100) / 100, l_orderkey * 10 + l_linenumber)
    / (CASE WHEN l_partkey % 10 = 0 AND CAST(l_shipdate AS DATE) < DATE '1998-06-01' THEN 4 ELSE 1 END) AS split_adjusted_close,
  sum(l_quantity) AS split_adjusted_volume
FROM lineitem WHERE l_linenumber <> 7 GROUP BY l_partkey, CAST(l_shipdate AS DATE)""",
    "v_name_changes": """
SELECT CAST(o_orderkey AS STRING) AS event_id, CAST(o_orderdate AS DATE) AS process_date,
  'C' || CAST(o_custkey - o_custkey % 2 AS STRING) AS old_symbol, 'C' || CAST(o_custkey - o_custkey % 2 + 2 + 2 * (o_orderkey % 3) AS STRING) AS new_symbol
FROM orders""",
    "v_actions": """
SELECT CAST(o_orderkey AS STRING) AS provider_event_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'forward_split' WHEN 1 THEN 'reverse_split' WHEN 2 THEN 'cash_dividend' WHEN 3 THEN 'cash_merger' WHEN 4 THEN 'name_change' WHEN 5 THEN 'spin_off' WHEN 6 THEN 'unit_split' ELSE 'stock_dividend' END AS action_type,
  CAST(o_orderdate AS DATE) AS process_date,
  CASE WHEN o_orderkey % 4 = 0 THEN CAST(o_orderdate AS DATE) + 1 ELSE NULL END AS effective_date,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) - 1 ELSE NULL END AS ex_date,
  CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE 'P' || CAST(o_custkey AS STRING) END AS primary_symbol,
  CASE WHEN o_orderkey % 2 = 0 THEN 'P' || CAST(o_custkey + 1 AS STRING) ELSE NULL END AS related_symbol,
  CAST(CAST(floor(o_totalprice) AS BIGINT) AS STRING) AS rate
FROM orders""",
    # every customer is a security with one symbol; two customers share a symbol, so symbols grow with the table
    "v_master": """
SELECT 'S' || CAST(c_custkey AS STRING) AS security_id, 'C' || CAST(c_custkey - c_custkey % 2 AS STRING) AS symbol, c_name AS company_name,
  c_custkey % 4 <> 0 AS active, CASE WHEN c_custkey % 4 = 0 THEN DATE '1998-01-01' + CAST(c_custkey % 900 AS INT) ELSE NULL END AS delisted_date,
  c_custkey % 7 <> 0 AS is_price_coverage_eligible, CASE WHEN c_custkey % 7 = 0 THEN 'ineligible_exchange' ELSE NULL END AS exclusion_reason,
  count(*) OVER (PARTITION BY c_custkey - c_custkey % 2) > 1 AS symbol_identity_conflict, 'F' || CAST(c_custkey AS STRING) AS share_class_figi, CAST(NULL AS STRING) AS composite_figi,
  CAST(c_custkey AS STRING) AS cik, 'XNYS' AS primary_exchange, CAST(NULL AS STRING) AS sector, c_mktsegment AS industry,
  'asset-' || CAST(c_custkey AS STRING) AS alpaca_asset_id, 'active' AS alpaca_status, TRUE AS alpaca_tradable, c_custkey % 9 = 0 AS is_known_reit,
  DATE '2001-01-01' + CAST(c_custkey % 300 AS INT) AS last_updated_utc, c_custkey % 5 <> 0 AS has_alpaca_asset
FROM customer""",
}

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A view over the tables of sf_dir; tables are named by path, so views of several directories can live together."""
    text = VIEWS[name]
    for t in TABLES:
        text = text.replace(f"FROM {t}", f"FROM parquet.`{sf_dir}/{t}.parquet`")
    return spark.sql(text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_views(sql: str, *names: str) -> str:
    """sql after a WITH list of the named views (those they build on first)."""
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n].strip()})" for n in names) + "\n" + sql.strip()
