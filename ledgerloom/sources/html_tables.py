"""Tables of landed HTML pages as rows of cells."""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as X

# Headers of the columns that are read, and texts of a symbol cell that name no symbol.
TICKER_HEADERS = ("rtc ticker", "ticker", "ticker symbol", "symbol")
SYMBOL_HEADERS = ("symbol", "ticker")
SECTOR_HEADERS = ("gics sector", "sector")
INDUSTRY_HEADERS = ("gics sub-industry", "gics sub industry", "sub-industry", "industry")
NO_TICKERS = ("N/A", "NA", "TICKER", "SYMBOL")
NO_SYMBOLS = ("SYMBOL", "TICKER")
CELL = "doc string, table_no int, row_no int, col_no int, text string"


class _Cells(HTMLParser):
    """Collects (table, row, column, text) with the texts of nested tags joined by blanks."""

    def __init__(self, row_tags: frozenset[str], cell_tags: frozenset[str], table_tags: frozenset[str]) -> None:
        super().__init__(convert_charrefs=True)
        self.row_tags, self.cell_tags, self.table_tags = row_tags, cell_tags, table_tags
        self.cells: list[tuple[int, int, int, str]] = []
        self.table = self.row = self.column = -1
        self.inside = 0
        self.text: list[str] | None = None

    def _flush(self) -> None:
        if self.text is not None:
            self.cells.append((self.table, self.row, self.column, " ".join(" ".join(self.text).split())))
        self.text = None

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in self.table_tags:
            self._flush()
            self.table, self.row, self.column = self.table + 1, -1, -1
            self.inside += 1
        elif self.inside and tag in self.row_tags:
            self._flush()
            self.row, self.column = self.row + 1, -1
        if self.inside and tag in self.cell_tags:
            self._flush()
            self.column += 1
            self.text = []

    def handle_endtag(self, tag: str) -> None:
        if tag in self.cell_tags or tag in self.row_tags:
            self._flush()
        if tag in self.table_tags:
            self._flush()
            self.inside = max(0, self.inside - 1)

    def handle_data(self, data: str) -> None:
        if self.text is not None and data.strip():
            self.text.append(data)


def html_cells(pages: DataFrame, doc: str = "doc", html: str = "html", tables: str = "table", rows: str = "tr", cells: str = "td th") -> DataFrame:
    """Cells of every page: doc, table_no, row_no, col_no, text (numbers from 0). Each page is parsed where it lies."""
    sets = [frozenset(x.split()) for x in (rows, cells, tables)]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for name, page in zip(batch["doc"], batch["html"]):
                parser = _Cells(*sets)
                parser.feed(page or "")
                parser.close()
                parser._flush()
                out += [(name, *cell) for cell in parser.cells]
            yield pd.DataFrame(out, columns=["doc", "table_no", "row_no", "col_no", "text"])

    return pages.select(F.col(doc).cast("string").alias("doc"), F.col(html).alias("html")).mapInPandas(run, CELL)


def landed_html(spark: SparkSession, path: str) -> DataFrame:
    """(doc, html) of the files under path."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("doc"), F.col("value").alias("html"))


def _header(text: Column) -> Column:
    return F.regexp_replace(F.lower(F.trim(F.translate(text, "‑–", "--"))), r"\s+", " ")


def _columns(cells: DataFrame, kinds: dict[str, tuple[str, ...]]) -> DataFrame:
    """(doc, table_no, one column number per kind): the first header of each kind in a table's first row."""
    heads = cells.filter("row_no = 0").select("doc", "table_no", "col_no", _header(F.col("text")).alias("head"))
    first = [F.min(F.when(F.col("head").isin(*names), F.col("col_no"))).alias(kind) for kind, names in kinds.items()]
    return heads.groupBy("doc", "table_no").agg(*first)


def ticker_symbols(cells: DataFrame) -> DataFrame:
    """Distinct symbols under a ticker header of any table; a cell may list several."""
    found = _columns(cells, {"at": TICKER_HEADERS}).filter("at is not null")
    own = cells.join(found, ["doc", "table_no"]).filter("col_no = at")
    values = own.select(F.explode(F.split("text", r"[,/\s]+")).alias("value")).select(X.symbol("value").alias("symbol"))
    return values.filter(F.col("symbol").isNotNull() & ~F.col("symbol").isin(*NO_TICKERS)).distinct()


def classifications(cells: DataFrame) -> DataFrame:
    """symbol, symbol_join_key, sector, industry of each page's first table with symbol and industry columns and rows.

    Of rows with one join key the first of the document counts; without a sector column sector is empty text.
    """
    found = _columns(cells, {"s": SYMBOL_HEADERS, "c": SECTOR_HEADERS, "i": INDUSTRY_HEADERS}).filter("s is not null and i is not null")
    own = cells.join(found, ["doc", "table_no"])
    text = lambda at: F.max(F.when(F.col("col_no") == F.col(at), F.col("text")))
    rows = own.groupBy("doc", "table_no", "row_no").agg(X.symbol(text("s")).alias("symbol"), text("c").alias("sector"), text("i").alias("industry"), F.max("col_no").alias("last"), F.first("s").alias("s"), F.first("c").alias("c"), F.first("i").alias("i"))
    rows = rows.filter((F.col("last") >= F.greatest("s", "i", F.coalesce("c", F.lit(0)))) & F.col("symbol").isNotNull() & ~F.col("symbol").isin(*NO_SYMBOLS))
    first = rows.groupBy("doc").agg(F.min("table_no").alias("table_no"))
    rows = rows.join(first, ["doc", "table_no"]).withColumn("symbol_join_key", X.join_key("symbol"))
    best = F.min_by(F.struct("symbol", F.coalesce("sector", F.lit("")).alias("sector"), "industry"), F.struct("doc", "row_no"))
    return rows.groupBy("symbol_join_key").agg(best.alias("r")).select("r.symbol", "symbol_join_key", "r.sector", "r.industry")
