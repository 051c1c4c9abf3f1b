"""HTML keys. Table and drop-down pages are rendered from customers, 100 per
page (a bounded ``collect_list``); link keys read the driver's ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.urls import manifest_filename
from granary.plans.registry import query
from granary.plans.tables import load
from granary.sources import html

PER_PAGE = 100
LINK_SUFFIXES = [",", "."]  # the driver pages link no .pdf/.csv; these suffixes do occur

# the header spans rows and columns; so do cells of customers with a negative balance
_HEAD = ('<tr><th colspan="2">Customer</th><th>Balance</th><th rowspan="2">Segment</th></tr>'
         "<tr><th>Name</th><th>Key</th><th>USD</th></tr>")


def customer_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = load(spark, sf_dir, "customer")
    bal = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    # a third of the rows lack their end tags, another third hold a table in a cell
    inner = F.when(F.col("c_custkey") % 3 == 1, F.lit("<table><tr><th>old<td>x</table>")).otherwise(F.lit(""))
    row = F.concat(F.lit("<tr><td> "), inner, F.col("c_name"), F.lit(" </td><td>"), F.col("c_custkey").cast("string"),
                   F.when(F.col("c_acctbal") < 0, F.concat(F.lit('</td><td colspan="2">'), bal))
                   .otherwise(F.concat(F.lit("</td><td>"), bal, F.lit("</td><td>"), F.col("c_mktsegment"))), F.lit("</td></tr>"))
    row = F.when(F.col("c_custkey") % 3 == 0, F.regexp_replace(row, "</t[dr]>", "")).otherwise(row)
    opt = F.concat(F.lit('<option value="'), F.col("c_custkey").cast("string"), F.lit('"  >'), F.col("c_name"),
                   F.lit(" </option>"))
    g = c.groupBy((F.col("c_custkey") / PER_PAGE).cast("bigint").alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct("c_custkey", row.alias("row"), opt.alias("opt")))).alias("rs"))
    page = F.concat(
        F.lit("<html><body><h1>Report</h1><table class=\"report\">"), F.lit(_HEAD),
        F.array_join(F.transform("rs", lambda x: x.getField("row")), ""), F.lit("</table>"),
        F.lit('<select id="fltrdistricts"><option value="9">Elsewhere</option></select>'),
        F.lit('<select name="s" id="fltrstates"><option value="">Select</option>'),
        F.array_join(F.transform("rs", lambda x: x.getField("opt")), ""),
        F.lit("</select><table><tr><td>second table</td></tr></table></body></html>"),
    )
    return g.select("page_id", page.alias("html"))


_CELLS = [("Customer_Name", "c_name"), ("Customer_Key", "CAST(c_custkey AS VARCHAR)"),
          ("Balance_USD", "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR)"),
          ("Segment", "CASE WHEN c_acctbal < 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) ELSE c_mktsegment END")]


@query(
    "html_table_rows",
    "WITH c AS (SELECT *, c_custkey // 100 AS page_id, "
    "CAST(row_number() OVER (PARTITION BY c_custkey // 100 ORDER BY c_custkey) - 1 AS INTEGER) AS row_no FROM customer)\n"
    + "\nUNION ALL\n".join(
        f"SELECT page_id, row_no, {j} AS col_no, '{name}' AS column_name, {expr} AS value FROM c"
        for j, (name, expr) in enumerate(_CELLS)
    ),
)
def html_table_rows(spark, sf_dir):
    cells = html.html_table_cells(customer_pages(spark, sf_dir))
    return cells.select("page_id", "row_no", "col_no", "column_name", "value")


@query(
    "html_option_pairs",
    "SELECT c_custkey // 100 AS page_id, c_custkey AS value, c_name AS label FROM customer",
)
def html_option_pairs(spark, sf_dir):
    return html.html_option_pairs(customer_pages(spark, sf_dir))


def link_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's pages with three links each appended: relative to the page, to the folder above it,
    and to a spreadsheet."""
    n = F.col("page_id").cast("string")
    more = F.concat(F.lit('<a href="files/r'), n, F.lit('.pdf">r</a><A class="x" HREF = \'../up/x'), n, F.lit('.CSV\'>x</a>'),
                    F.lit('<a href="https://docs.google.com/spreadsheets/d/ID'), n, F.lit('/edit#gid=0">s</a>'))
    return load(spark, sf_dir, "pages").withColumn("html", F.concat(F.coalesce("html", F.lit("")), more))


SUFFIXES = [*LINK_SUFFIXES, ".pdf", ".csv"]
_HREFS_SQL = """SELECT page_id, url AS base, replace(unnest(regexp_extract_all(html, '<a\\b[^>]*?\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1)), '&amp;', '&') AS href FROM pages"""
_SUFFIX_SQL = " OR ".join(f"ends_with(lower(href), '{s}')" for s in LINK_SUFFIXES)
_JOIN_SQL = """CASE
  WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.\\-]*:') THEN href
  WHEN starts_with(href, '//') THEN regexp_extract(base, '^([a-zA-Z][a-zA-Z0-9+.\\-]*):', 1) || ':' || href
  WHEN starts_with(href, '/') THEN regexp_extract(base, '^([a-zA-Z][a-zA-Z0-9+.\\-]*://[^/?#]*)', 1) || href
  ELSE NULL END"""
# the folder of a page: its url without query and fragment, up to the last slash
_FOLDER = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '')"
LINKS_SQL = f"""SELECT page_id, href, {_JOIN_SQL} AS url FROM ({_HREFS_SQL}) h WHERE {_SUFFIX_SQL}
UNION ALL SELECT page_id, 'files/r' || page_id || '.pdf', {_FOLDER} || 'files/r' || page_id || '.pdf' FROM pages
UNION ALL SELECT page_id, '../up/x' || page_id || '.CSV', regexp_replace({_FOLDER}, '[^/]*/$', '') || 'up/x' || page_id || '.CSV' FROM pages
UNION ALL SELECT page_id, 'https://docs.google.com/spreadsheets/d/ID' || page_id || '/edit#gid=0',
  'https://docs.google.com/spreadsheets/d/ID' || page_id || '/export?format=csv' FROM pages"""


@query("html_link_discovery", LINKS_SQL)
def html_link_discovery(spark, sf_dir):
    return html.html_links(link_pages(spark, sf_dir), suffixes=SUFFIXES)


@query("link_distinct", f"SELECT DISTINCT url FROM ({LINKS_SQL}) l")
def link_distinct(spark, sf_dir):
    return html.link_distinct(html.html_links(link_pages(spark, sf_dir), suffixes=SUFFIXES))


@query(
    "manifest_filename",
    """SELECT page_id, url, CASE
  WHEN contains(url, 'docs.google.com') AND contains(url, 'export?format=csv')
    THEN regexp_extract(url, '/d/([^/]*)', 1) || '.csv'
  WHEN split_part(string_split(url, '/')[-1], '?', 1) = '' THEN 'download_' || left(md5(url), 8)
  ELSE split_part(string_split(url, '/')[-1], '?', 1) END AS filename FROM pages""",
)
def manifest_filename_q(spark, sf_dir):
    p = load(spark, sf_dir, "pages")
    return p.select("page_id", "url", manifest_filename(F.col("url")).alias("filename"))
