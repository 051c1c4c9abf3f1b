"""HTML page sources: first-table rows, select-option pairs, download links.

Only the table parse needs Python (``mapInPandas`` with the stdlib HTML
parser, one pandas batch of pages at a time); options and links are regular
expressions evaluated by Spark.
"""

from __future__ import annotations

import sys
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.functions.headers import flatten_headers
from granary.functions.text import py_strip
from granary.functions.urls import DOWNLOAD_SUFFIXES, SHEET_MARKER, has_download_suffix, sheet_export_url, url_join

# Executors get this module's functions by value: no package install needed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TABLE_ROW_SCHEMA = "page_id long, row_no int, col_no int, header_parts array<string>, value string"
OPTION_BLOCK = r'(?s)id="fltrstates"(.*?)</select>'
OPTION_PAIR = r'<option value="(\d+)"[^>]*>([^<]+)</option>'
ANCHOR_HREF = r"""(?i)<a\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""


def _span(value: str | None) -> int:
    """A span attribute; anything but a number from 1 to 1000 counts as 1."""
    return int(value) if value and value.strip().isdigit() and 0 < int(value) <= 1000 else 1


def expand_spans(rows: list[list[tuple[bool, str, int, int]]]) -> list[list[tuple[bool, str]]]:
    """Every cell in each row and column that it spans."""
    out: list[list[tuple[bool, str]]] = []
    open_: dict[int, tuple[int, tuple[bool, str]]] = {}  # column -> (rows to go, cell)
    for row in rows:
        line: list[tuple[bool, str]] = []
        after: dict[int, tuple[int, tuple[bool, str]]] = {}

        def carried() -> None:
            while len(line) in open_:
                left, cell = open_[len(line)]
                if left > 1:
                    after[len(line)] = (left - 1, cell)
                line.append(cell)

        for is_th, text, down, across in row:
            carried()
            for _ in range(across):
                if down > 1:
                    after[len(line)] = (down - 1, (is_th, text))
                line.append((is_th, text))
        carried()
        out.append(line)
        open_ = after
    return out


class _FirstTable(HTMLParser):
    """Collects the cells of the first <table> as (is_header, text, rows, columns) rows.

    End tags of cells and rows may be missing: a cell ends where the next cell,
    row or section starts and at the table's or page's end, and a cell without
    a row opens one. A table inside a cell is a table of its own: its rows and
    text don't count, what follows it still belongs to the cell.
    """

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.depth = 0
        self.done = False
        self.rows: list[list[tuple[bool, str, int, int]]] = []
        self._cell: list[str] | None = None
        self._is_th = False
        self._span = (1, 1)
        self._in_row = False

    def _end_cell(self) -> None:
        if self._cell is not None:
            self.rows[-1].append((self._is_th, "".join(self._cell).strip(), *self._span))
            self._cell = None

    def _end_row(self) -> None:
        self._end_cell()
        self._in_row = False

    def handle_starttag(self, tag, attrs):
        if self.done:
            return
        if tag == "table":
            self.depth += 1
        elif self.depth == 1 and tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()
            if tag == "tr":
                self.rows.append([])
                self._in_row = True
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
            if not self._in_row:
                self.rows.append([])
                self._in_row = True
            self._cell, self._is_th = [], tag == "th"
            self._span = tuple(_span(dict(attrs).get(k)) for k in ("rowspan", "colspan"))

    def handle_endtag(self, tag):
        if self.done or not self.depth:
            return
        if tag == "table":
            self.depth -= 1
            if not self.depth:
                self._end_row()
                self.done = True
        elif self.depth == 1 and tag in ("td", "th"):
            self._end_cell()
        elif self.depth == 1 and tag in ("tr", "thead", "tbody", "tfoot"):
            self._end_row()

    def handle_data(self, data):
        if self._cell is not None and self.depth == 1:
            self._cell.append(data)

    def close(self):
        super().close()
        self._end_row()


def parse_first_table(html: str):
    """(header rows, data rows) of the first table; leading all-<th> rows
    form the (possibly multi-row) header. Cells stand in every row and column
    that their rowspan and colspan cover."""
    p = _FirstTable()
    p.feed(html or "")
    p.close()
    rows = [r for r in expand_spans(p.rows) if r]
    n_head = 0
    while n_head < len(rows) and all(is_th for is_th, _ in rows[n_head]):
        n_head += 1
    head = [[t for _, t in r] for r in rows[:n_head]]
    body = [[t for _, t in r] for r in rows[n_head:]]
    return head, body


def _table_batches(batches):
    for pdf in batches:
        for pid, html in zip(pdf["page_id"], pdf["html"]):  # one frame per page
            out = []
            head, body = parse_first_table(html)
            width = max([len(r) for r in head + body] or [0])
            for i, row in enumerate(body):
                for j in range(width):
                    parts = [h[j] if j < len(h) else "" for h in head] or [str(j)]
                    out.append((int(pid), i, j, parts, row[j] if j < len(row) else None))
            if out:
                yield pd.DataFrame(out, columns=["page_id", "row_no", "col_no", "header_parts", "value"])


def html_table_cells(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """First <table> of every page -> one row per data cell with its header
    parts and the flattened column name. Pages are parsed where they are
    (no shuffle); each page is handled whole by one Python worker."""
    src = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    cells = src.mapInPandas(_table_batches, TABLE_ROW_SCHEMA)
    return cells.withColumn("column_name", flatten_headers(F.col("header_parts")))


def html_option_pairs(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """(value, label) pairs of the states drop-down; label trimmed, numeric
    values only."""
    block = F.regexp_extract(F.col(html_col), OPTION_BLOCK, 1)
    vals = F.regexp_extract_all(block, F.lit(OPTION_PAIR), 1)
    labels = F.regexp_extract_all(block, F.lit(OPTION_PAIR), 2)
    z = pages.select(F.col(id_col).alias("page_id"), F.explode(F.arrays_zip(vals.alias("v"), labels.alias("l"))).alias("p"))
    return z.where(F.col("p.v") != "").select(
        "page_id", F.col("p.v").cast("bigint").alias("value"), py_strip(F.col("p.l")).alias("label"))


def html_links(pages: DataFrame, base: str | None = None, suffixes: list[str] | None = None,
               id_col: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """Anchors whose lower-cased href ends with a download suffix, resolved
    against ``base`` (default: the page's own URL); spreadsheet links become
    CSV-export URLs. One row per (page, link)."""
    hrefs = pages.select(
        F.col(id_col).alias("page_id"),
        (F.lit(base) if base else F.col(url_col)).alias("base"),
        F.explode(F.regexp_extract_all(F.col(html_col), F.lit(ANCHOR_HREF), 1)).alias("href"),
    ).withColumn("href", F.replace(F.col("href"), F.lit("&amp;"), F.lit("&")))
    sfx = suffixes if suffixes is not None else DOWNLOAD_SUFFIXES
    is_file = has_download_suffix(F.col("href"), sfx)
    is_sheet = F.col("href").contains(SHEET_MARKER)
    return hrefs.where(is_file | is_sheet).select(
        "page_id", "href",
        F.when(is_file, url_join(F.col("base"), F.col("href"))).otherwise(sheet_export_url(F.col("href"))).alias("url"),
    )


def link_distinct(links: DataFrame) -> DataFrame:
    return links.select("url").distinct()
