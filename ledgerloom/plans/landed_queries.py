"""Queries of landing, scanning, publishing and validation: data that Spark derives from the tables is written and read back."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions import scalars as X
from ..operators import actions as A
from ..operators import audit as U
from ..operators import bars as B
from ..operators import episodes as E
from ..operators import identity as I
from ..operators import validate as V
from ..sources import html_tables as H
from ..sources import pages as P
from ..sources.tables import bar_state, current, metadata, published, required_table, shared_dir, written
from . import publish as O
from .fixtures import FLOOR, SNAPSHOT, table, view
from .queries import _AUDIT_END, _CASES, _SAMPLE, _audit_master, _plain_with, query


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def _landed(spark: SparkSession, runs: dict[str, DataFrame]) -> DataFrame:
    """The pages (body) of several runs, landed as one file set a day and scanned again together."""
    base = _folder(spark, "landed")
    for day, pages in runs.items():
        O.land_json_pages(pages, f"{base}/{day}.jsonl.gz", "provider", "/v1/pages")
    return P.landed_pages(spark, f"{base}/*")


# ---- the occurrence landed last wins, also if the later file is the larger one


@query("SELECT symbol, date, raw_close + CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 7 = 0 THEN 2 ELSE 1 END AS raw_close FROM v_bars_raw", "v_bars_raw")
def landed_bars(spark: SparkSession, d: str) -> DataFrame:
    """A small run, a whole one that replaces it, and a small one that replaces a part again. The bars of a symbol are gathered once."""
    bars = view(spark, d, "v_bars_raw").groupBy("symbol").agg(F.collect_list(F.struct("date", "raw_close")).alias("b"))
    bars = written(bars, "bars-to-land").withColumn("k", F.expr("CAST(substr(symbol, 2) AS BIGINT)"))

    def pages(rows: DataFrame, more: int) -> DataFrame:
        bar = lambda b: F.struct(F.concat(b["date"].cast("string"), F.lit("T05:00:00Z")).alias("t"), (b["raw_close"] + more).alias("c"))
        return rows.select(F.to_json(F.struct(F.create_map("symbol", F.transform("b", bar)).alias("bars"))).alias("body"))

    runs = {"2001-01-01": pages(bars.filter("k % 5 = 0"), 0), "2001-01-02": pages(bars, 1), "2001-01-03": pages(bars.filter("k % 7 = 0"), 2)}
    rows = P.bar_rows(_landed(spark, runs), "raw").select("page_no", "pos", "symbol", "date", "raw_close")
    return B.one_bar_per_day(rows).select("symbol", "date", "raw_close")


@query("SELECT 'share_class_figi:F' || CAST(p_partkey AS VARCHAR) AS security_id, 'P' || CAST(p_partkey AS VARCHAR) AS symbol, CASE WHEN p_partkey % 11 = 0 THEN 'last ' ELSE 'second ' END || p_name AS company_name FROM part")
def landed_listings(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    k = F.col("p_partkey").cast("string")

    def pages(rows: DataFrame, word: str) -> DataFrame:
        entry = F.struct(F.concat(F.lit(" p"), k).alias("ticker"), F.concat(F.lit(f"{word} "), "p_name").alias("name"), F.concat(F.lit("f"), k).alias("share_class_figi"), F.lit(True).alias("active"), F.lit("2001-01-01").alias("last_updated_utc"))
        return rows.groupBy(F.floor(F.col("p_partkey") / 40).alias("g")).agg(F.collect_list(entry).alias("results")).select(F.to_json(F.struct("results")).alias("body"))

    runs = {"2001-01-01": pages(part.filter("p_partkey % 3 = 0"), "first"), "2001-01-02": pages(part, "second"), "2001-01-03": pages(part.filter("p_partkey % 11 = 0"), "last")}
    return I.one_per_security(I.normalised_listings(P.listing_rows(_landed(spark, runs)))).select("security_id", "symbol", "company_name")


_KINDS = sorted(P.ACTION_TYPES)


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS provider_event_id, ({[P.ACTION_TYPES[k] for k in _KINDS]})[o_orderkey % 16 + 1] AS action_type, CASE WHEN o_orderkey % 7 = 0 THEN '2' ELSE '1' END AS rate FROM orders")
def landed_actions(spark: SparkSession, d: str) -> DataFrame:
    """All sixteen collections; on a tie of date and type the action landed last counts."""
    orders = table(spark, d, "orders").withColumn("kind", F.element_at(F.array(*[F.lit(k) for k in _KINDS]), (F.col("o_orderkey") % 16 + 1).cast("int")))

    def pages(rows: DataFrame, rate: int) -> DataFrame:
        entry = F.struct(F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderdate").cast("date").cast("string").alias("process_date"), F.lit(str(rate)).alias("rate"))
        each = rows.groupBy("o_custkey", "kind").agg(F.collect_list(entry).alias("v")).groupBy("o_custkey").agg(F.map_from_entries(F.collect_list(F.struct("kind", "v"))).alias("corporate_actions"))
        return each.select(F.to_json(F.struct("corporate_actions")).alias("body"))

    runs = {"2001-01-01": pages(orders.filter("o_orderkey % 5 = 0"), 0), "2001-01-02": pages(orders, 1), "2001-01-03": pages(orders.filter("o_orderkey % 7 = 0"), 2)}
    return A.one_per_event(A.parsed_actions(P.action_rows(_landed(spark, runs)))).select("provider_event_id", "action_type", "rate")


# ---- other pages


@query("""
SELECT 'P' || CAST(p_partkey AS VARCHAR) || '-A' AS symbol_join_key, 'P' || CAST(p_partkey AS VARCHAR) || '.A' AS alpaca_symbol, 'asset-' || CAST(p_partkey AS VARCHAR) AS alpaca_asset_id, 'NYSE' AS alpaca_exchange,
  CASE WHEN p_partkey % 4 = 0 THEN 'inactive' ELSE 'active' END AS alpaca_status, CASE p_partkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS alpaca_tradable
FROM part WHERE p_partkey % 6 <> 0""")
def asset_pages(spark: SparkSession, d: str) -> DataFrame:
    """Assets of landed pages; those without a symbol are skipped."""
    k = F.col("p_partkey").cast("string")
    symbol = F.when(F.expr("p_partkey % 6 = 0"), F.lit("  ")).otherwise(F.concat(F.lit(" p"), k, F.lit(".a")))
    word = F.element_at(F.array(F.lit("true"), F.lit("no"), F.lit("Yes"), F.lit(""), F.lit(None).cast("string")), (F.col("p_partkey") % 5 + 1).cast("int"))
    entry = F.struct(F.concat(F.lit(" asset-"), k).alias("id"), symbol.alias("symbol"), F.lit("nyse").alias("exchange"), F.when(F.expr("p_partkey % 4 = 0"), "Inactive").otherwise("ACTIVE").alias("status"), word.alias("tradable"))
    pages = table(spark, d, "part").groupBy(F.floor(F.col("p_partkey") / 25).alias("g")).agg(F.collect_list(entry).alias("assets")).select(F.to_json(F.struct("assets")).alias("body"))
    return P.asset_rows(_landed(spark, {"2001-01-01": pages})).select("symbol_join_key", "alpaca_symbol", "alpaca_asset_id", "alpaca_exchange", "alpaca_status", "alpaca_tradable")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS event_id, CAST(o_orderdate AS DATE) AS process_date, 'A' || CAST(o_custkey AS VARCHAR) AS old_symbol, 'B' || CAST(o_custkey AS VARCHAR) AS new_symbol, CASE WHEN o_orderkey % 3 = 0 THEN 'c' || CAST(o_orderkey AS VARCHAR) END AS old_cusip
FROM orders WHERE o_orderkey % 4 NOT IN (1, 2) AND o_orderkey % 9 <> 0""")
def name_change_pages(spark: SparkSession, d: str) -> DataFrame:
    """Name changes of landed pages: pseudo-symbols, unchanged symbols and changes without a date are skipped."""
    c, k = F.col("o_custkey").cast("string"), F.col("o_orderkey")
    old = F.when(k % 4 == 1, F.concat(F.lit("9"), c)).otherwise(F.concat(F.lit(" a"), c))
    new = F.when(k % 4 == 2, F.concat(F.lit("A"), c)).otherwise(F.concat(F.lit("b"), c))
    day = F.when(k % 9 != 0, F.col("o_orderdate").cast("date").cast("string"))
    entry = F.struct(k.cast("string").alias("id"), old.alias("old_symbol"), new.alias("new_symbol"), day.alias("process_date"), F.when(k % 3 == 0, F.concat(F.lit(" c"), k.cast("string"))).alias("old_cusip"))
    pages = table(spark, d, "orders").groupBy("o_custkey").agg(F.collect_list(entry).alias("name_changes"))
    pages = pages.select(F.to_json(F.struct(F.struct("name_changes").alias("corporate_actions"))).alias("body"))
    return P.name_change_rows(_landed(spark, {"2001-01-01": pages})).select("event_id", "process_date", "old_symbol", "new_symbol", "old_cusip")


@query("""
SELECT CASE WHEN c_custkey % 2 = 0 THEN 'sip' ELSE 'iex' END AS feed, 'C' || CAST(c_custkey AS VARCHAR) AS requested,
  CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 7 = 0 THEN 'C' || CAST(c_custkey AS VARCHAR) || ';D' || CAST(c_custkey AS VARCHAR) ELSE 'C' || CAST(c_custkey AS VARCHAR) END AS returned,
  CASE WHEN c_custkey % 5 = 0 THEN 'status ' || CAST(c_custkey % 3 + 500 AS VARCHAR) END AS request_error FROM customer""")
def audit_results(spark: SparkSession, d: str) -> DataFrame:
    """What each request of landed audit envelopes returned, and its error."""
    k = F.col("c_custkey")
    own, other = F.concat(F.lit("C"), k.cast("string")), F.concat(F.lit("D"), k.cast("string"))
    bar = F.array(F.struct(F.lit("2001-01-02T05:00:00Z").alias("t"), F.lit(1).alias("v")))
    bars = F.when(k % 5 == 0, F.lit(None)).when(k % 7 == 0, F.create_map(own, bar, other, bar)).otherwise(F.create_map(own, bar))
    request = F.struct(F.array(own).alias("symbols"), F.when(k % 2 == 0, "sip").otherwise("iex").alias("feed"))
    error = F.when(k % 5 == 0, F.concat(F.lit("status "), (k % 3 + 500).cast("string")))
    pages = table(spark, d, "customer").select(F.to_json(F.struct(request.alias("request"), F.struct(bars.alias("bars")).alias("response"), error.alias("error"))).alias("body"))
    _, results = P.audit_rows(_landed(spark, {"2001-01-01": pages}))
    return results.select("feed", "requested", F.array_join("returned_symbols", ";").alias("returned"), "request_error")


def _html(d: str, spark: SparkSession, head: list[str], cells: list[Column]) -> DataFrame:
    """(doc, html): tables of 50 parts each, behind a table without such columns."""
    row = F.concat(F.lit("<tr>"), *[x for c in cells for x in (F.lit("<td> "), c, F.lit("</td>"))], F.lit("</tr>"))
    pages = table(spark, d, "part").groupBy(F.floor(F.col("p_partkey") / 50).cast("string").alias("doc")).agg(F.concat_ws("", F.collect_list(row)).alias("rows"))
    heads = "".join(f"<th>{h}</th>" for h in head)
    return pages.select("doc", F.concat(F.lit(f"<p>Text</p><table><tr><th>Other</th></tr><tr><td>x</td></tr></table><table id=t><tr>{heads}</tr>"), "rows", F.lit("</table>")).alias("html"))


@query("SELECT DISTINCT 'P' || CAST(p_partkey + i AS VARCHAR) AS symbol FROM part, (VALUES (0), (100000)) v(i) WHERE NOT (i = 100000 AND p_partkey % 3 = 0)")
def html_tickers(spark: SparkSession, d: str) -> DataFrame:
    """Symbols of table cells, some of which list two; placeholders are skipped."""
    k = F.col("p_partkey")
    other = F.when(k % 3 == 0, F.lit("NA")).otherwise(F.concat(F.lit("P"), (k + 100000).cast("string")))
    cells = H.html_cells(_html(d, spark, ["Company", "Ticker"], [F.col("p_name"), F.concat(F.lit("p"), k.cast("string"), F.lit(", "), other)]))
    return H.ticker_symbols(cells)


@query("SELECT 'P' || CAST(p_partkey AS VARCHAR) || '.A' AS symbol, 'P' || CAST(p_partkey AS VARCHAR) || '-A' AS symbol_join_key, 'sector ' || CAST(p_size % 7 AS VARCHAR) AS sector, p_type AS industry FROM part")
def html_classes(spark: SparkSession, d: str) -> DataFrame:
    cells = [F.concat(F.lit("p"), F.col("p_partkey").cast("string"), F.lit(".a")), F.concat(F.lit("sector "), (F.col("p_size") % 7).cast("string")), F.col("p_type")]
    return H.classifications(H.html_cells(_html(d, spark, ["Symbol", "GICS Sector", "GICS Sub\N{NON-BREAKING HYPHEN}Industry"], cells)))


# ---- scalars


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS provider_event_id,
  CASE o_orderkey % 3 WHEN 0 THEN 'q' WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'c' ELSE 'o' END ELSE 's' END || CAST(o_orderkey AS VARCHAR) AS primary_cusip,
  CASE o_orderkey % 3 WHEN 0 THEN 'r' ELSE 'n' END || CAST(o_orderkey AS VARCHAR) AS related_cusip,
  CASE o_orderkey % 4 WHEN 0 THEN '1' WHEN 1 THEN '2' WHEN 2 THEN '3' END AS old_rate, CASE WHEN o_orderkey % 5 = 0 THEN '5' ELSE '4' END AS new_rate,
  CAST(o_orderdate AS DATE) + 3 AS payable_date, CASE WHEN o_orderkey % 2 = 0 THEN CAST(o_orderdate AS DATE) + 3 ELSE CAST(o_orderdate AS DATE) END AS event_date,
  CASE o_orderkey % 5 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN TRUE WHEN 3 THEN FALSE END AS special
FROM orders""")
def actions_routed(spark: SparkSession, d: str) -> DataFrame:
    """Cusips by type, the first rate that is set, payable dates and flags of payloads."""
    k = F.col("o_orderkey")
    name = lambda letter: F.concat(F.lit(letter), k.cast("string"))
    day = F.col("o_orderdate").cast("date")
    kind = F.element_at(F.array(F.lit("stock_merger"), F.lit("cash_dividend"), F.lit("spin_off")), (k % 3 + 1).cast("int"))
    own = {
        "id": k.cast("string"), "process_date": day.cast("string"), "payable_date": F.date_add(day, 3).cast("string"), "ex_date": F.when(k % 2 != 0, day.cast("string")),
        "acquiree_cusip": name("q"), "acquirer_cusip": name("r"), "cusip": F.when(k % 2 == 0, name("c")).otherwise(F.lit(" ")), "old_cusip": name("o"), "new_cusip": name("n"), "source_cusip": name("s"),
        "old_rate": F.when(k % 4 == 0, 1).when(k % 4 == 1, 0), "source_rate": F.when(k % 4 == 1, "2").when(k % 4 == 2, "0"), "acquiree_rate": F.when(k % 4 == 2, "3"),
        "new_rate": F.when(k % 5 == 0, "5"), "acquirer_rate": F.lit(4), "special": F.element_at(F.array(F.lit("true"), F.lit("0"), F.lit("x"), F.lit("False"), F.lit(None).cast("string")), (k % 5 + 1).cast("int")),
    }
    rows = table(spark, d, "orders").select(kind.alias("action_type"), F.to_json(F.struct(*[c.alias(n) for n, c in own.items()])).alias("raw"))
    return A.parsed_actions(rows).select("provider_event_id", "primary_cusip", "related_cusip", "old_rate", "new_rate", "payable_date", "event_date", "special")


@query("""
SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN 'a' WHEN 2 THEN NULL WHEN 3 THEN 'a;b' ELSE 'b' END AS rest,
  replace(event_type, 'li', '[REDACTED]') AS safe_text, CASE event_id % 4 WHEN 0 THEN TRUE WHEN 1 THEN FALSE WHEN 2 THEN FALSE END AS flag FROM events""")
def payload_words(spark: SparkSession, d: str) -> DataFrame:
    """A tag taken out of lists, a secret out of texts, and flags of payloads."""
    k = F.col("event_id")
    words = F.element_at(F.array(*[F.lit(x) for x in ("late", "a;late", "", "a;late;b")], F.lit("late;b")), (k % 5 + 1).cast("int"))
    flags = F.element_at(F.array(F.lit("1"), F.lit("FALSE"), F.lit("0.0"), F.lit(None).cast("string")), (k % 4 + 1).cast("int"))
    return table(spark, d, "events").select("event_id", X.without(words, "late").alias("rest"), X.scrubbed("event_type", "li", "").alias("safe_text"), X.optional_bool(flags).alias("flag"))


# ---- plans and samples


@query("SELECT 'P' || CAST(p_partkey AS VARCHAR) AS symbol, CASE p_partkey WHEN 5 THEN 1 WHEN 3 THEN 2 ELSE 3 END AS place FROM part WHERE p_partkey IN (3, 5, 150)")
def pilot_symbols(spark: SparkSession, d: str) -> DataFrame:
    tickers = table(spark, d, "part").select(F.concat(F.lit("p"), F.col("p_partkey").cast("string")).alias("provider_symbol"))
    return B.pilot_symbols(tickers, ("P5", "P3", "P150", "Q1"))


@query("""
WITH s AS (SELECT DISTINCT l_partkey AS k FROM lineitem), x AS (SELECT DISTINCT o_custkey AS k FROM orders WHERE o_orderkey % 8 = 0)
SELECT min(CASE WHEN x.k IS NULL THEN DATE '2001-10-25' ELSE DATE '1996-01-01' END) AS first_start, count_if(x.k IS NULL) AS usual, count(*) AS symbols FROM s LEFT JOIN x ON s.k = x.k""")
def plan_range(spark: SparkSession, d: str) -> DataFrame:
    """The first day that an update asks for."""
    symbols = table(spark, d, "lineitem").select(F.concat(F.lit("P"), F.col("l_partkey").cast("string")).alias("symbol"))
    pending = table(spark, d, "orders").filter("o_orderkey % 8 = 0").select(F.concat(F.lit("p"), F.col("o_custkey").cast("string")).alias("symbol"))
    plan = B.update_plan(symbols, dt.date(2001, 11, 1), pending, None, 7, FLOOR)
    return plan.agg(F.min("start_date").alias("first_start"), F.count_if(F.col("start_date") != F.lit(FLOOR)).alias("usual"), F.count(F.lit(1)).alias("symbols"))


_WITH_EPISODES = (
    _SAMPLE[: _SAMPLE.index(", sa AS (")].replace("parts AS (", "parts0 AS (")
    + """
, ep AS (SELECT 'S' || CAST(p_partkey AS VARCHAR) AS security_id, 'Q' || CAST(p_partkey AS VARCHAR) AS symbol, DATE '1996-01-01' AS vf, DATE '1999-03-01' + CAST(p_partkey % 500 AS INT) AS vt, FALSE AS current FROM part
  UNION ALL SELECT 'S' || CAST(p_partkey AS VARCHAR), 'P' || CAST(p_partkey % 1900 AS VARCHAR), DATE '1999-03-02' + CAST(p_partkey % 500 AS INT), NULL, TRUE FROM part)
, changed AS (SELECT DISTINCT security_id FROM parts0 WHERE list_contains(categories, 'ticker_change'))
, have AS (SELECT DISTINCT security_id, symbol FROM parts0)
, parts AS (SELECT security_id, symbol, kind, place, categories, roles, event_type, event_date FROM parts0
  UNION ALL SELECT ep.security_id, ep.symbol, 5, 0, CASE WHEN have.symbol IS NULL THEN ['ticker_change'] ELSE CAST([] AS VARCHAR[]) END,
    list_filter([CASE WHEN vf > DATE '1996-01-01' THEN 'expected_start' END, CASE WHEN vt IS NOT NULL THEN 'expected_end' END], lambda x: x IS NOT NULL), CASE WHEN have.symbol IS NULL THEN 'ticker_change' END, NULL
  FROM ep JOIN changed ON ep.security_id = changed.security_id LEFT JOIN have ON have.security_id = ep.security_id AND have.symbol = ep.symbol)
, sa AS (SELECT security_id, symbol, array_to_string(list_sort(list_distinct(flatten(list(categories)))), ';') AS sample_categories, array_to_string(list_sort(list_distinct(flatten(list(roles)))), ';') AS sample_roles,
    first(event_type ORDER BY kind, place) FILTER (event_type IS NOT NULL) AS known_event_type FROM parts GROUP BY 1, 2)
SELECT sa.security_id || '|' || sa.symbol AS sample_id, sample_categories, sample_roles, known_event_type, CAST(ep.vf AS DATE) AS symbol_valid_from, CAST(ep.vt AS DATE) AS symbol_valid_to
FROM sa LEFT JOIN ep ON ep.security_id = sa.security_id AND ep.symbol = sa.symbol"""
)


@query(_plain_with(_WITH_EPISODES))
def audit_sample_episodes(spark: SparkSession, d: str) -> DataFrame:
    """The sample with the dated symbols of securities that changed theirs."""
    k = F.col("p_partkey")
    border = lambda days: F.date_add(F.lit(dt.date(1999, 3, 1)), (k % 500 + days).cast("int"))
    none = F.lit(None).cast("date")
    rows = [(F.concat(F.lit("Q"), k.cast("string")), F.lit(FLOOR), border(0), F.lit(False)), (F.concat(F.lit("P"), (k % 1900).cast("string")), border(1), none, F.lit(True))]
    names = ("symbol", "symbol_valid_from", "symbol_valid_to", "is_current_symbol")
    each = F.array(*[F.struct(*[c.alias(n) for c, n in zip(row, names)]) for row in rows])
    episodes = table(spark, d, "part").select(F.concat(F.lit("S"), k.cast("string")).alias("security_id"), F.inline(each))
    sample = U.audit_sample(_audit_master(spark, d), _AUDIT_END, episodes, FLOOR, _CASES, (("P9", "P10"),))
    return sample.select("sample_id", "sample_categories", "sample_roles", "known_event_type", "symbol_valid_from", "symbol_valid_to")


_ROWS = """
WITH m AS (SELECT 'S' || CAST(c_custkey // 4 AS VARCHAR) AS security_id, 'C' || CAST(c_custkey AS VARCHAR) AS symbol, c_custkey % 8 = 1 AS active,
  CASE WHEN c_custkey % 8 <> 1 AND c_custkey % 8 <> 6 THEN CAST(DATE '1998-01-01' + CAST(c_custkey * 37 % 1100 AS INT) AS DATE) END AS delisted_date FROM customer)
, t AS (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY active DESC, delisted_date DESC NULLS FIRST, symbol DESC) AS n, count_if(active) OVER (PARTITION BY security_id) AS actives FROM m)"""


def _securities(spark: SparkSession, d: str) -> DataFrame:
    """A master in which each security has up to four symbols, one of them active or none."""
    k = F.col("c_custkey")
    gone = F.when((k % 8 != 1) & (k % 8 != 6), F.date_add(F.lit(dt.date(1998, 1, 1)), (k * 37 % 1100).cast("int")))
    text = {c: F.lit(None).cast("string") for c in ("exclusion_reason", "share_class_figi", "composite_figi", "cik", "primary_exchange")}
    own = {"security_id": F.concat(F.lit("S"), F.floor(k / 4).cast("string")), "symbol": F.concat(F.lit("C"), k.cast("string")), "company_name": F.col("c_name"), "active": k % 8 == 1, "delisted_date": gone, "is_price_coverage_eligible": F.lit(True), "symbol_identity_conflict": F.lit(False)} | text
    return table(spark, d, "customer").select(*[c.alias(n) for n, c in own.items()])


@query(_ROWS + " SELECT security_id, symbol AS terminal, actives = 1 AS is_single FROM t WHERE n = 1")
def terminals(spark: SparkSession, d: str) -> DataFrame:
    return E.terminals(_securities(spark, d))


@query(
    _ROWS
    + """
, b AS (SELECT m.security_id, m.symbol, CASE WHEN NOT (t.actives = 1 AND m.symbol = t.symbol) THEN m.delisted_date - 1 END AS known_to, t.actives = 1 AND m.symbol = t.symbol AS current FROM m JOIN t ON m.security_id = t.security_id AND t.n = 1)
, f AS (SELECT *, CASE WHEN row_number() OVER w = 1 THEN DATE '1996-01-01' ELSE CAST(lag(known_to) OVER w + 1 AS DATE) END AS vf FROM b WINDOW w AS (PARTITION BY security_id ORDER BY known_to NULLS LAST, symbol))
SELECT security_id, symbol, vf AS symbol_valid_from, CAST(known_to AS DATE) AS symbol_valid_to, CASE WHEN vf IS NULL OR coalesce(vf > known_to, FALSE) THEN 'unresolved' WHEN current THEN 'current' ELSE 'bounded' END AS episode_status FROM f"""
)
def episodes_inferred(spark: SparkSession, d: str) -> DataFrame:
    """Securities of several symbols without name changes: bounds come from delistings and neighbours."""
    changes = spark.createDataFrame([], "event_id string, process_date date, old_symbol string, new_symbol string")
    return E.symbol_episodes(_securities(spark, d), changes, SNAPSHOT, FLOOR).select("security_id", "symbol", "symbol_valid_from", "symbol_valid_to", "episode_status")


@query("""
SELECT 'P' || CAST(p_partkey AS VARCHAR) || '.A' AS symbol, CASE p_partkey % 3 WHEN 0 THEN 'normalized_symbol' WHEN 1 THEN 'exact_symbol' ELSE 'no_current_asset' END AS status,
  CASE p_partkey % 3 WHEN 0 THEN 'provider_symbol_spelling_differs' WHEN 2 THEN 'no_current_alpaca_asset' END AS coverage_reason, CASE WHEN p_partkey % 3 <> 2 THEN 'asset-' || CAST(p_partkey AS VARCHAR) END AS asset FROM part""")
def master_spellings(spark: SparkSession, d: str) -> DataFrame:
    """Listings whose asset is spelled alike, otherwise, or missing."""
    part, k = table(spark, d, "part"), F.col("p_partkey").cast("string")
    text = {c: F.lit(None).cast("string") for c in ("cik", "composite_figi", "type", "market", "locale", "currency_name", "primary_exchange", "delisted_utc", "last_updated_utc")}
    listings = part.select(F.concat(F.lit("P"), k, F.lit(".A")).alias("ticker"), F.col("p_name").alias("name"), F.concat(F.lit("F"), k).alias("share_class_figi"), F.lit("true").alias("active"), *[c.alias(n) for n, c in text.items()])
    spelled = F.concat(F.lit("p"), k, F.when(F.expr("p_partkey % 3 = 0"), "-a").otherwise(".a"))
    assets = part.filter("p_partkey % 3 <> 2").select(F.concat(F.lit("asset-"), k).alias("id"), spelled.alias("symbol"), F.lit("NYSE").alias("exchange"), F.lit("active").alias("status"), F.lit("true").alias("tradable"))
    master = I.security_master(listings, P.normalised_assets(assets), SNAPSHOT, None, None, FLOOR)
    return master.select("symbol", F.col("alpaca_asset_match_status").alias("status"), "coverage_reason", F.col("alpaca_asset_id").alias("asset"))


# ---- published tables


_PRICES = O.Dataset("market.prices", "market", "replace_snapshot", "all_prices", ["symbol", "date"], "date", "symbol", ["symbol", "date"])


def _prices(spark: SparkSession, d: str) -> str:
    """Prices published twice; the second table replaces the first."""
    base = _folder(spark, "published")
    prices = view(spark, d, "v_bars_raw").select("symbol", "date", "raw_close", "raw_volume")
    O.publish({"prices": (prices.withColumn("raw_close", F.lit(0.0)), _PRICES, {"run": 1})}, base)
    O.publish({"prices": (prices, _PRICES, {"run": 2})}, base)
    return base


@query("SELECT symbol, date, raw_close FROM v_bars_raw", "v_bars_raw")
def published_table(spark: SparkSession, d: str) -> DataFrame:
    return published(spark, _prices(spark, d), "prices", ["symbol", "date", "raw_close"])


@query("""
SELECT 2 AS run, 'market.prices' AS dataset_name, count(*) AS row_count, count(*) - count(DISTINCT symbol || CAST(date AS VARCHAR)) AS duplicate_key_count, count(DISTINCT symbol) AS symbol_count, CAST(min(date) AS VARCHAR) AS min_date, CAST(max(date) AS VARCHAR) AS max_date, CAST(max(date) AS DATE) AS state_date
FROM v_bars_raw""", "v_bars_raw")
def published_metadata(spark: SparkSession, d: str) -> DataFrame:
    base = _prices(spark, d)
    about = metadata(spark, base, "prices", "run long, dataset_name string, row_count long, duplicate_key_count long, symbol_count long, min_date string, max_date string")
    return about.crossJoin(bar_state(spark, base, "prices").select(F.col("max_date").alias("state_date")))  # one row each


@query("SELECT symbol, count(*) AS bars, min(date) AS first_date FROM v_bars_raw GROUP BY 1", "v_bars_raw")
def published_order(spark: SparkSession, d: str) -> DataFrame:
    """Published rows lie in the dataset's order: within a file no row precedes the one before it."""
    rows = required_table(spark, _prices(spark, d), "prices", "prices").select("symbol", "date", F.col("_metadata.file_path").alias("file"), F.monotonically_increasing_id().alias("n"))
    from pyspark.sql import Window

    before = F.lag(F.struct("symbol", "date")).over(Window.partitionBy("file").orderBy("n"))
    kept = rows.withColumn("ordered", F.coalesce(before <= F.struct("symbol", "date"), F.lit(True))).filter("ordered")
    return kept.groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"), F.min("date").alias("first_date"))


_PARTS = O.Dataset("market.bars", "market", "incremental_merge", "all_prices", ["symbol", "date"], "date", "symbol", ["symbol", "date"], "yyyy", 2)
_UPDATED = """
, u AS (SELECT symbol, date, raw_close + CASE WHEN CAST(substr(symbol, 2) AS BIGINT) % 5 = 0 AND date >= DATE '2000-01-01' THEN 1 ELSE 0 END AS raw_close FROM v_bars_raw)"""


def _updated(spark: SparkSession, d: str) -> tuple[str, list[str]]:
    """Bars published in parts, then an update of some symbols from a date on; the folder, and the parts that stayed.

    As in the jobs, counts of parts and symbols make the metadata; what is computed is written down and read back.
    """
    base = _folder(spark, "updated")
    old = written(view(spark, d, "v_bars_raw").select("symbol", "date", "raw_close"), "updated-bars")
    part = O.part_of(_PARTS, F.col("date"), F.col("symbol"))
    full = lambda df: df.select("symbol", "date", "raw_close", F.col("raw_close").alias("split_adjusted_close"), F.col("symbol").alias("security_id"))
    counts = lambda states: B.state_metrics(states).first().asDict()
    states = written(B.symbol_state(full(old), part), "updated-states")
    O.publish({"bars": (old, _PARTS, counts(states)), "state": (states, _PRICES_STATE, {})}, base)
    mine = "CAST(substr(symbol, 2) AS BIGINT) % 5 = 0"
    plan = written(old.filter(mine).select("symbol").distinct().withColumn("start_date", F.lit(dt.date(2000, 1, 1))), "updated-plan")
    fresh = old.filter(f"{mine} AND date >= DATE '2000-01-01'").withColumn("raw_close", F.col("raw_close") + 1)
    before = current(spark, base)["tables"]["bars"]["parts"]
    touched = O.touched_parts(plan, _PARTS, "symbol", "start_date", list(before))
    rows = written(B.replaced(published(spark, base, "bars", parts=touched), fresh, plan), "updated-rows")
    states = written(published(spark, base, "state").filter(~F.col("part").isin(touched)).unionByName(B.symbol_state(full(rows), part)), "updated-states")
    done = O.publish({"bars": (rows, _PARTS, counts(states)), "state": (states, _PRICES_STATE, {})}, base, {"bars": touched})
    return base, sorted(k for k, v in done["bars"]["parts"].items() if before.get(k) == v)


_PRICES_STATE = O.Dataset("market.bars.state", "market", "replace_snapshot", "counts", ["part", "symbol"], sort=["part", "symbol"])


@query(_UPDATED + " SELECT symbol, date, raw_close FROM u", "v_bars_raw")
def updated_parts(spark: SparkSession, d: str) -> DataFrame:
    """The table after an update that rewrote the parts of its years only."""
    base, stayed = _updated(spark, d)
    assert stayed and all(p < "2000" for p in stayed), stayed
    return published(spark, base, "bars")


@query(_UPDATED + " SELECT count(*) AS row_count, count(DISTINCT symbol) AS symbol_count, count(DISTINCT symbol) AS security_id_count, min(date)::VARCHAR AS min_date, max(date)::VARCHAR AS max_date, 0 AS duplicate_key_count, count(*) FILTER (raw_close IS NULL) AS missing_adjustment_pair_count, 0 AS split_adjustment_difference_count FROM u", "v_bars_raw")
def updated_state(spark: SparkSession, d: str) -> DataFrame:
    """Metrics after the update, from the states of symbols and parts."""
    return B.state_metrics(published(spark, _updated(spark, d)[0], "state"))


@query("SELECT 'prices' AS name, true AS found, count(*) AS rows FROM v_bars_raw UNION ALL SELECT 'absent', false, 0", "v_bars_raw")
def missing_table(spark: SparkSession, d: str) -> DataFrame:
    """A published table is counted, one that is not published is refused."""
    base, found = _prices(spark, d), []
    for name in ("prices", "absent"):
        try:
            found.append((name, True, required_table(spark, base, name, name).count()))
        except FileNotFoundError:
            found.append((name, False, 0))
    return spark.createDataFrame(found, "name string, found boolean, rows long")


@query("""
SELECT 's' || CAST(o_custkey AS VARCHAR) AS security_id, arg_max(o_orderkey, o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 12, '0')) FILTER (o_orderstatus = 'F') AS exact_key,
  arg_max(o_orderkey, (o_orderstatus = 'F')::INT::VARCHAR || o_orderdate::VARCHAR || lpad(o_orderkey::VARCHAR, 12, '0')) AS any_key FROM orders GROUP BY o_custkey""")
def ticker_choice(spark: SparkSession, d: str) -> DataFrame:
    """Securities with many master rows: the newest row of the exact symbol gives the asset, the newest of all the sector."""
    orders = table(spark, d, "orders")
    security, key = F.concat(F.lit("s"), F.col("o_custkey").cast("string")), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")
    done = F.col("o_orderstatus") == "F"
    none = lambda c, t="string": F.lit(None).cast(t).alias(c)
    symbol = F.when(done, "DONE").otherwise(F.concat(F.lit("X"), key))
    updated = F.concat(F.col("o_orderdate").cast("date").cast("string"), key)
    master = orders.select(security.alias("security_id"), symbol.alias("symbol"), done.alias("active"), updated.alias("last_updated_utc"), F.col("o_orderkey").cast("string").alias("sector"), none("industry"), F.col("o_orderkey").cast("string").alias("alpaca_asset_id"), none("alpaca_status"), none("alpaca_tradable", "boolean"), none("is_known_reit", "boolean"))
    names = orders.select(security.alias("security_id")).distinct()
    known = {"security_id": F.col("security_id"), "episode_id": F.concat("security_id", F.lit("|"), F.col("symbol")), "symbol": F.col("symbol"), "is_price_coverage_eligible": F.lit(True)}
    episodes = names.withColumn("symbol", F.explode(F.array(F.lit("DONE"), F.lit("NONE")))).select(*[known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in S.EPISODES.fields])
    got = E.episode_tickers(episodes, master)
    exact = got.filter("provider_symbol = 'DONE'").select("security_id", F.col("alpaca_asset_id").cast("long").alias("exact_key"))
    other = got.filter("provider_symbol = 'NONE'").select("security_id", F.col("sector").cast("long").alias("any_key"))
    return exact.join(other, "security_id")


@query("SELECT 'bars' AS name, count(*) AS rows, 'mapped' AS status FROM v_bars_raw WHERE CAST(substr(symbol, 2) AS BIGINT) % 3 <> 0 UNION ALL SELECT 'quarantine', count(*), 'ambiguous_episode_overlap' FROM v_bars_raw WHERE CAST(substr(symbol, 2) AS BIGINT) % 3 = 0", "v_bars_raw")
def published_bars(spark: SparkSession, d: str) -> DataFrame:
    """Bars and their quarantine published side by side, with all published columns."""
    base = _folder(spark, "published")
    status = F.when(F.expr("CAST(substr(symbol, 2) AS BIGINT) % 3 = 0"), "ambiguous_episode_overlap").otherwise("mapped")
    bars = B.as_bars(view(spark, d, "v_bars_raw").withColumns({"identity_status": status, "split_adjusted_close": F.col("raw_close")}), SNAPSHOT)
    O.publish({"bars": (B.safe(bars), _PRICES, {}), "quarantine": (B.quarantined(bars), _PRICES, {})}, base)
    one = lambda name: required_table(spark, base, name, name).select(*S.BARS.names).groupBy(F.lit(name).alias("name"), F.col("identity_status").alias("status")).agg(F.count(F.lit(1)).alias("rows"))
    return one("bars").unionByName(one("quarantine"))


@query("SELECT 'provider' AS provider, 'https://h/pages' AS source_endpoint, count(*) AS page_count, CAST(sum(strlen(url) + 1) AS BIGINT) AS byte_count FROM pages")
def landed_text(spark: SparkSession, d: str) -> DataFrame:
    """The manifest of landed texts."""
    pages = table(spark, d, "pages").select(F.col("url").alias("body"))
    return O.land_text(pages, f"{_folder(spark, 'text')}/urls.txt", "provider", "https://h/pages?key=1").select("provider", "source_endpoint", "page_count", "byte_count")


# ---- checks


def _fails(check) -> bool:
    try:
        check()
    except ValueError:
        return True
    return False


@query("""
SELECT 'unique' AS check, (SELECT count(*) > count(DISTINCT p_partkey) FROM part) AS fails UNION ALL SELECT 'repeated', (SELECT count(*) > count(DISTINCT o_custkey) FROM orders)
UNION ALL SELECT 'columns', (SELECT count(*) = 0 FROM region) UNION ALL SELECT 'lacking', (SELECT count(*) > 0 FROM region)
UNION ALL SELECT 'values', (SELECT count(DISTINCT o_orderstatus) < 3 FROM orders WHERE o_orderstatus IN ('F', 'O', 'P')) UNION ALL SELECT 'categories', (SELECT count(*) = 0 FROM orders WHERE o_orderstatus = 'X')
UNION ALL SELECT 'keys', (SELECT count(*) > 0 FROM orders WHERE o_orderkey IS NULL) UNION ALL SELECT 'dates', (SELECT count(*) > 0 FROM orders WHERE o_orderkey % 2 = 1)
UNION ALL SELECT 'least', (SELECT min(p_partkey) < 1 FROM part) UNION ALL SELECT 'mode', (SELECT count(*) > 0 FROM part)""")
def checks(spark: SparkSession, d: str) -> DataFrame:
    """Which checks fail the tables."""
    part, orders, region = (table(spark, d, t) for t in ("part", "orders", "region"))
    actions = orders.select(F.lit("split").alias("action_type"), F.col("o_orderkey").cast("string").alias("provider_event_id"), F.col("o_orderdate").cast("date").alias("process_date"))
    dated = actions.withColumn("process_date", F.when(F.expr("CAST(provider_event_id AS BIGINT) % 2 = 0"), F.col("process_date")))
    found = {
        "unique": lambda: V.require_unique(part, ["p_partkey"], "part"),
        "repeated": lambda: V.require_unique(orders, ["o_custkey"], "orders"),
        "columns": lambda: V.require_columns(region, ["r_name"], "region"),
        "lacking": lambda: V.require_columns(region, ["r_none"], "region"),
        "values": lambda: V.require_values(orders, "o_orderstatus", ("F", "O", "P"), "orders"),
        "categories": lambda: V.require_values(orders, "o_orderstatus", ("F", "X"), "orders"),
        "keys": lambda: V.require_action_keys(actions),
        "dates": lambda: V.require_action_keys(dated),
        "least": lambda: V.require_at_least(part.agg(F.min("p_partkey")).first()[0], 1, "least key"),
        "mode": lambda: V.require_one_of(part.first()["p_name"], ("pilot", "backfill"), "mode"),
    }
    return spark.createDataFrame([(name, _fails(check)) for name, check in found.items()], "check string, fails boolean")
