"""Ingest-side keys: page envelopes, hashing, lineage columns, bronze merge,
silver mapping and scalar coercions."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.hashing import record_hash, record_hash_compat
from granary.functions.numeric import nan_to_null, safe_float
from granary.functions.text import error_truncate
from granary.functions.urls import redact_params
from granary.operators import bronze, ingest, records
from granary.plans import crop, pages
from granary.plans.registry import query
from granary.plans.tables import load
from granary.session import scratch_path

_PAGE_SQL = "CAST(o_orderkey // 100 * 100 AS BIGINT)"


@query(
    "page_explode_records",
    f"""SELECT {_PAGE_SQL} AS offset,
  CAST(row_number() OVER (PARTITION BY o_orderkey // 100 ORDER BY o_orderkey) - 1 AS INTEGER) AS record_no,
  o_custkey, o_orderdate, t_orderkey AS o_orderkey, o_orderpriority, o_orderstatus, o_totalprice
FROM ({pages.ORDER_TEXT_SQL}) o""",
)
def page_explode_records(spark, sf_dir):
    good, _ = records.split_error_pages(pages.orders_pages(spark, sf_dir))
    r = records.explode_records(good, keep=["offset"])
    return r.select("offset", "record_no", *pages.record_columns(r))


@query(
    "page_explode_fields",
    f"""SELECT p.offset, f.field_id, f.field_name, f.field_type
FROM (SELECT DISTINCT {_PAGE_SQL} AS offset FROM orders) p,
     (VALUES {", ".join(f"('{i}', '{n}', '{t}')" for i, n, t in pages.FIELDS)}) f(field_id, field_name, field_type)""",
)
def page_explode_fields(spark, sf_dir):
    good, _ = records.split_error_pages(pages.orders_pages(spark, sf_dir))
    return records.explode_fields(good, keep=["offset"])


@query(
    "page_total",
    f"""SELECT p.offset, p.attempt, CASE WHEN p.attempt = 1 THEN (SELECT count(*) FROM orders) ELSE 0 END AS total
FROM (SELECT {_PAGE_SQL} AS offset, 1 AS attempt FROM orders GROUP BY 1
      UNION ALL
      SELECT {_PAGE_SQL}, 0 FROM orders GROUP BY 1 HAVING max(o_totalprice) > {pages.ERROR_PRICE}) p""",
)
def page_total(spark, sf_dir):
    p = records.parse_envelope(pages.orders_pages(spark, sf_dir))
    return p.select("offset", "attempt", records.page_total(F.col("env")).alias("total"))


@query(
    "page_error_filter",
    f"""SELECT {_PAGE_SQL} AS offset, 0 AS attempt, 'error' AS status, 'rate limited' AS error
FROM orders GROUP BY 1 HAVING max(o_totalprice) > {pages.ERROR_PRICE}""",
)
def page_error_filter(spark, sf_dir):
    _, bad = records.split_error_pages(pages.orders_pages(spark, sf_dir))
    return bad.select("offset", "attempt", F.col("env.status").alias("status"), F.col("env.error").alias("error"))


_PAGES_CTE = f"""WITH late AS ({crop.LATE_FIELDS_SQL}),
h AS (SELECT *, {crop.LATE_HASH_SQL} AS hash,
  TIMESTAMP '2024-01-01 00:00:00' + to_milliseconds(page_id % 1000) AS fetched FROM late),
pg AS (SELECT l_orderkey // {crop.PAGE_DIV} AS page_id, l_linenumber // {crop.PAGE_LINES} AS part, count(*) AS n,
  max(l_extendedprice) AS mx FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY 1, 2)
"""

INGEST_SQL = _PAGES_CTE + f"""SELECT hash AS source_record_hash, '{crop.DATASET_NAME}' AS source_dataset,
  '{crop.RESOURCE_ID}' AS source_resource_id, CASE WHEN l_linestatus = 'F' THEN 'earlier' ELSE '{crop.SOURCE_SYSTEM}' END AS source_system,
  fetched AS ingested_at, {", ".join(crop.RECORD_KEYS)}, note, CAST(NULL AS VARCHAR) AS n_name FROM h
UNION ALL
SELECT sha256(to_json(MAP {{'n_name': n_name}})), '{crop.DATASET_NAME}', '{crop.RESOURCE_ID}', 'earlier', TIMESTAMP '2023-06-01 00:00:00',
  {", ".join("NULL" for _ in crop.RECORD_KEYS)}, NULL, n_name FROM nation"""


def _crop_ingest(spark, sf_dir) -> ingest.Ingested:
    """Pages with faults into a bronze table that holds the records of
    finished lines (ingested by an earlier system) and records that this batch
    doesn't have; the catalogue knows the usual fields."""
    names = {"dataset": crop.DATASET_NAME, "resource": crop.RESOURCE_ID}
    earlier = crop.page_rows(spark, sf_dir, faults=True).where(F.col("l_linestatus") == "F").select("record")
    old = load(spark, sf_dir, "nation").select(bronze.columns_to_record(["n_name"]).alias("record"))
    both = bronze.enrich(earlier.unionByName(old), source_dataset=crop.DATASET_NAME, source_resource_id=crop.RESOURCE_ID, source_system="earlier")
    both = both.withColumn("ingested_at", F.lit("2023-06-01 00:00:00").cast("timestamp_ntz")).withColumn("seq", F.lit(0))
    table = ingest.bronze_table(spark, scratch_path(spark, "bronze-crop"), slots=8)
    bronze.merge_into(table, both, seq=["seq"])
    catalogue = spark.createDataFrame(
        [(crop.RESOURCE_ID, f, "keyword", "2023-06-01 00:00:00") for f in [*crop.RECORD_KEYS, "n_name"]],
        "dataset_id string, field_name string, field_type string, discovered_at string",
    ).withColumn("discovered_at", F.col("discovered_at").cast("timestamp_ntz"))
    done = ingest.ingest(crop.crop_portions(spark, sf_dir, faults=True), table, catalogue, system=crop.SOURCE_SYSTEM, **names)
    table.vacuum()  # the pages are of one run, so nothing reads the slots from before
    return done


@query("ingest_batch", INGEST_SQL)
def ingest_batch(spark, sf_dir):
    """Landed pages -> routing -> records -> hash -> merge into an existing
    table -> one text column per catalogued field, late ones included."""
    return _crop_ingest(spark, sf_dir).table


@query("ingest_rejects", _PAGES_CTE + f"""SELECT page_id * {crop.PAGE_DIV} AS offset_value, 0 AS attempt,
  CASE WHEN mx > {crop.ERROR_PRICE} THEN 'error' ELSE 'malformed' END AS reason, 'failed' AS status,
  CASE WHEN mx > {crop.ERROR_PRICE} THEN 'upstream timeout' ELSE 'malformed page' END AS error_message
FROM pg WHERE mx > {crop.CUT_PRICE}""")
def ingest_rejects(spark, sf_dir):
    return _crop_ingest(spark, sf_dir).rejects.drop("run_id")


@query("ingest_catalogue", _PAGES_CTE + f"""SELECT '{crop.RESOURCE_ID}' AS dataset_id, f AS field_name, 'keyword' AS field_type,
  TIMESTAMP '2023-06-01 00:00:00' AS discovered_at FROM (SELECT unnest({[*crop.RECORD_KEYS, "n_name"]}) AS f)
UNION ALL SELECT '{crop.RESOURCE_ID}', 'note', 'unknown', arg_min(fetched, page_id) FROM h WHERE note IS NOT NULL HAVING count(*) > 0""")
def ingest_catalogue(spark, sf_dir):
    return _crop_ingest(spark, sf_dir).catalogue


@query("ingest_metrics", _PAGES_CTE + f""", m AS (SELECT (SELECT date_diff('microsecond', min(fetched), max(fetched)) / 1e6 FROM h) AS s,
  (SELECT count(*) FROM h WHERE l_linestatus <> 'F') AS new)
SELECT 'run-0001' AS run_id, CAST((SELECT sum(n) FROM pg) AS BIGINT) AS records_fetched, new AS records_inserted,
  (SELECT count(*) FROM h WHERE l_linestatus = 'F') AS records_updated, (SELECT count(*) FROM pg WHERE mx > {crop.CUT_PRICE}) AS records_failed,
  round(s, 2) AS duration_seconds, CASE WHEN s > 0 THEN round(new / s, 2) ELSE 0.0 END AS throughput_per_second FROM m""")
def ingest_metrics(spark, sf_dir):
    return _crop_ingest(spark, sf_dir).metrics


HTML_PAGES_SQL = "SELECT page_id, 'empty' AS reason FROM pages WHERE html IS NOT NULL AND (contains(html, 'No Data Found') OR NOT contains(html, 'table'))"


@query("page_html_empty", HTML_PAGES_SQL)
def page_html_empty(spark, sf_dir):
    """HTML answers without data are set aside by the same routing as JSON pages."""
    p = load(spark, sf_dir, "pages").select("page_id", F.col("html").alias("raw_json"))
    _, bad = records.split_error_pages(p)
    return bad.where(F.col("reason") == "empty").select("page_id", "reason")


@query(
    "record_hash",
    f"SELECT c_custkey, {pages.CUSTOMER_HASH_SQL} AS record_hash FROM customer",
)
def record_hash_q(spark, sf_dir):
    c = load(spark, sf_dir, "customer")
    return c.select("c_custkey", record_hash(pages.customer_record()).alias("record_hash"))


@query(
    "record_hash_compat",
    """SELECT p_partkey, sha256('{"label":"' || replace(p_type, 'E', '\\u00e9') || '","name":"' || p_name || '"}') AS record_hash FROM part""",
)
def record_hash_compat_q(spark, sf_dir):
    """The hash that escapes non-ASCII characters; every E of the type is made an é here."""
    p = load(spark, sf_dir, "part")
    rec = F.create_map(F.lit("name"), F.col("p_name"), F.lit("label"), F.replace(F.col("p_type"), F.lit("E"), F.lit("é")))
    return p.select("p_partkey", record_hash_compat(rec).alias("record_hash"))


@query(
    "lineage_enrich",
    f"""SELECT c_custkey, 'customers' AS source_dataset, 'cust-res' AS source_resource_id,
  'tables' AS source_system, {pages.CUSTOMER_HASH_SQL} AS source_record_hash FROM customer""",
)
def lineage_enrich(spark, sf_dir):
    c = load(spark, sf_dir, "customer").select("c_custkey", pages.customer_record().alias("record"))
    e = bronze.enrich(c, source_dataset="customers", source_resource_id="cust-res", source_system="tables")
    return e.drop("record")


@query(
    "bronze_stringify",
    """SELECT c_custkey, k AS field, v AS value FROM (
  SELECT c_custkey, unnest(map_keys(m)) AS k, unnest(map_values(m)) AS v FROM (
    SELECT c_custkey, MAP {'c_acctbal': CAST(c_acctbal AS VARCHAR), 'c_credit': CAST(c_acctbal * 10000 AS VARCHAR),
      'c_rate': CAST(c_acctbal / 16777216 AS VARCHAR), 'c_custkey': CAST(c_custkey AS VARCHAR),
      'c_mktsegment': c_mktsegment, 'c_name': c_name, 'c_nationkey': CAST(c_nationkey AS VARCHAR)} AS m
    FROM customer))""",
)
def bronze_stringify(spark, sf_dir):
    """Typed row -> text record (``str(v)``; NULL stays NULL), one row per field."""
    c = load(spark, sf_dir, "customer").withColumn("c_credit", F.col("c_acctbal") * 10000)
    c = c.withColumn("c_rate", F.col("c_acctbal") / 16777216)
    rec = bronze.row_record(c, ["c_acctbal", "c_credit", "c_rate", "c_custkey", "c_mktsegment", "c_name", "c_nationkey"])
    return c.select("c_custkey", F.explode(rec).alias("field", "value"))


UPSERT_SQL = f"""WITH e AS (SELECT {pages.CUSTOMER_HASH_SQL} AS h, 'customers' AS ds, TIMESTAMP '2024-01-01 00:00:00' AS ts FROM customer),
b0 AS (SELECT {pages.CUSTOMER_HASH_SQL} AS h, 'customers-refresh' AS ds, TIMESTAMP '2024-02-01 00:00:00' AS ts FROM customer WHERE c_mktsegment = 'BUILDING'
       UNION ALL
       SELECT {pages.SUPPLIER_HASH_SQL}, 'suppliers', TIMESTAMP '2024-02-01 00:00:00' FROM supplier),
b AS (SELECT h, min(ds) AS ds, max(ts) AS ts FROM b0 GROUP BY h)
SELECT coalesce(e.h, b.h) AS source_record_hash,
  CASE WHEN e.h IS NOT NULL THEN e.ds ELSE b.ds END AS source_dataset,
  greatest(e.ts, b.ts) AS ingested_at,
  e.h IS NOT NULL AS was_present, b.h IS NOT NULL AS in_batch
FROM e FULL OUTER JOIN b ON e.h = b.h"""


@query("bronze_upsert", UPSERT_SQL)
def bronze_upsert_q(spark, sf_dir):
    """A batch merged into a stored table; the flags come from the snapshots before and after."""
    c = load(spark, sf_dir, "customer")
    s = load(spark, sf_dir, "supplier")
    lineage = dict(source_resource_id="res", source_system="tables")

    def rows(df, record, dataset, day):
        rec = bronze.enrich(df.select(record.alias("record")), source_dataset=dataset, **lineage)
        return rec.withColumn("ingested_at", F.lit(f"2024-0{day}-01 00:00:00").cast("timestamp_ntz")).withColumn("seq", F.lit(day))

    table = ingest.bronze_table(spark, scratch_path(spark, "bronze-customers"), slots=8)
    bronze.merge_into(table, rows(c, pages.customer_record(), "customers", 1), seq=["seq"])
    before = table.snapshot()
    again = rows(c.where(F.col("c_mktsegment") == "BUILDING"), pages.customer_record(), "customers-refresh", 2)
    batch = again.unionByName(rows(s, pages.supplier_record(), "suppliers", 2))
    bronze.merge_into(table, batch, seq=["seq"])
    known = table.read(at=before).select("source_record_hash", F.lit(True).alias("known"))
    return table.read().join(known, "source_record_hash", "left").select(
        "source_record_hash", "source_dataset", "ingested_at", F.col("known").isNotNull().alias("was_present"),
        (F.col("ingested_at") >= F.lit("2024-02-01").cast("timestamp_ntz")).alias("in_batch"))


@query("silver_map", crop.CROP_SILVER_SQL)
def silver_map_q(spark, sf_dir):
    return crop.crop_silver(spark, sf_dir, by_map=True)


_NUM = r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"
SAFE_FLOAT_SQL = f"""SELECT l_orderkey, l_linenumber, t AS text,
  CASE WHEN regexp_full_match(replace(regexp_replace(t, '^\\s+|\\s+$', '', 'g'), ',', ''), '{_NUM[1:-1]}')
       THEN CAST(replace(regexp_replace(t, '^\\s+|\\s+$', '', 'g'), ',', '') AS DOUBLE) END AS value
FROM (SELECT l_orderkey, l_linenumber,
  CASE l_linenumber
    WHEN 1 THEN format('{{:,.2f}}', l_extendedprice)
    WHEN 2 THEN '  ' || CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) || ' '
    WHEN 3 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'd'
    WHEN 4 THEN ''
    WHEN 5 THEN 'n/a'
    WHEN 6 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '_000'
    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || 'e2' END AS t
  FROM lineitem) x"""


@query("safe_float", SAFE_FLOAT_SQL)
def safe_float_q(spark, sf_dir):
    li = load(spark, sf_dir, "lineitem")
    q = F.col("l_quantity").cast("bigint").cast("string")
    t = (
        F.when(F.col("l_linenumber") == 1, F.format_number("l_extendedprice", 2))
        .when(F.col("l_linenumber") == 2, F.concat(F.lit("  "), F.col("l_extendedprice").cast("decimal(12,2)").cast("string"), F.lit(" ")))
        .when(F.col("l_linenumber") == 3, F.concat(q, F.lit("d")))
        .when(F.col("l_linenumber") == 4, F.lit(""))
        .when(F.col("l_linenumber") == 5, F.lit("n/a"))
        .when(F.col("l_linenumber") == 6, F.concat(q, F.lit("_000")))
        .otherwise(F.concat(q, F.lit("e2")))
    )
    x = li.select("l_orderkey", "l_linenumber", t.alias("text"))
    return x.select("l_orderkey", "l_linenumber", "text", safe_float(F.col("text")).alias("value"))


@query(
    "null_normalise",
    """SELECT l_orderkey, l_linenumber, d AS discount, t AS tax FROM (
  SELECT l_orderkey, l_linenumber,
    CASE WHEN l_discount = 0 THEN NULL ELSE l_discount END AS d,
    CASE WHEN l_tax = 0 THEN NULL ELSE l_tax END AS t FROM lineitem) x
WHERE d IS NOT NULL OR t IS NOT NULL""",
)
def null_normalise(spark, sf_dir):
    """NaN -> NULL, then drop rows whose every value column is missing."""
    li = load(spark, sf_dir, "lineitem")
    nan = F.lit(float("nan"))
    x = li.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_discount") == 0, nan).otherwise(F.col("l_discount")).alias("discount"),
        F.when(F.col("l_tax") == 0, nan).otherwise(F.col("l_tax")).alias("tax"),
    )
    x = x.select("l_orderkey", "l_linenumber", nan_to_null(F.col("discount")).alias("discount"),
                 nan_to_null(F.col("tax")).alias("tax"))
    return x.dropna(how="all", subset=["discount", "tax"])


@query(
    "redact_params",
    f"""SELECT p.offset, k.key, CASE k.key WHEN 'api-key' THEN '***' WHEN 'format' THEN 'json'
  WHEN 'offset' THEN CAST(p.offset AS VARCHAR) ELSE '100' END AS value
FROM (SELECT DISTINCT {_PAGE_SQL} AS offset FROM orders) p, (VALUES ('api-key'), ('format'), ('offset'), ('limit')) k(key)""",
)
def redact_params_q(spark, sf_dir):
    good, _ = records.split_error_pages(pages.orders_pages(spark, sf_dir))
    return good.select("offset", F.explode(redact_params(F.col("request_params"))).alias("key", "value"))


@query(
    "request_url",
    f"""SELECT DISTINCT {_PAGE_SQL} AS offset,
  '{pages.BASE_URL}?offset=' || CAST(o_orderkey // 100 * 100 AS VARCHAR) || '&limit=100' AS request_url FROM orders""",
)
def request_url_q(spark, sf_dir):
    good, _ = records.split_error_pages(pages.orders_pages(spark, sf_dir))
    return good.select("offset", "request_url")


@query("error_truncate", "SELECT doc_id, left(text, 2000) AS error_message FROM documents")
def error_truncate_q(spark, sf_dir):
    d = load(spark, sf_dir, "documents")
    return d.select("doc_id", error_truncate(F.col("text")).alias("error_message"))
