"""Crop-statistics input derived from the driver tables, and the ingest chain
over it: records -> page envelopes -> records -> hash -> upsert -> silver.

Binding (same definition in Spark below and in the oracle SQL):
state_name = r_name, district_name = n_name, crop = p_brand,
season = l_returnflag (A/N/R -> Kharif/Rabi/Whole_Year), crop_year = year of
l_shipdate, area_ = l_quantity, production_ = l_extendedprice,
yield = l_extendedprice / l_quantity truncated to 0.01. All lineitem columns
travel along so every record is distinct. Faults are derived from the row's
own discount/tax values (no row is dropped): NULL crop, padded crop, NULL or
malformed or ranged year, negative area (some very large or very small),
NULL district.
Numbers are rendered as DECIMAL(p,2) text ("17.00") so the text, and so the
hash, is identical in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.hashing import record_hash, struct_hash
from granary.operators import bronze, records, silver
from granary.plans.tables import load, spread

RESOURCE_ID = "crop-apy"
DATASET_NAME = "District-wise, season-wise crop production statistics"
SOURCE_SYSTEM = "tables"
PAGE_DIV = 20  # orders per page
PORTION_LINES = 4_000_000  # lines of a portion of pages that is landed at once
PAGE_LINES = 4  # an envelope holds the lines of 20 orders whose numbers fall into one group of 4
BASE_URL = "https://source.example/resource/crop-apy"

RECORD_KEYS = [
    "area_", "crop", "crop_year", "district_name", "l_discount", "l_linenumber", "l_linestatus",
    "l_orderkey", "l_partkey", "l_shipdate", "l_suppkey", "l_tax", "production_", "season",
    "state_name", "yield",
]


def _dec(c: Column, p: int = 12, s: int = 2) -> Column:
    """Text of a number as a DECIMAL(p,s) prints it ("17.00", "-0.05"). One cast, so that the generated
    method of a whole record stays small enough to be compiled."""
    return c.cast(f"decimal({p},{s})").cast("string")


def _page_keys() -> tuple[Column, Column]:
    return (F.col("l_orderkey") / PAGE_DIV).cast("bigint"), (F.col("l_linenumber") / PAGE_LINES).cast("bigint")


def crop_lines(spark: SparkSession, sf_dir: str, dealt: bool = False, portion: tuple[int, int] = (0, 1)) -> DataFrame:
    """lineitem joined to its part, supplier, nation and region; ``dealt`` to all cores if the scan has too few
    splits for them; ``portion`` (k, n): the lines of one page in n, the k-th."""
    li = load(spark, sf_dir, "lineitem")
    if portion[1] > 1:
        li = li.where(F.coalesce(F.pmod(_page_keys()[0], F.lit(portion[1])), F.lit(0)) == portion[0])
    li = spread(li) if dealt else li
    part = load(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supp = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (
        li.join(part, li.l_partkey == part.p_partkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )


def crop_fields(lines: DataFrame, extra: list[str] | None = None) -> DataFrame:
    """Flat text fields of each crop record (plus page id and ``extra``
    source columns)."""
    y = F.year("l_shipdate")
    ys = y.cast("string")
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    qty = F.col("l_quantity").cast("bigint")
    v = F.floor(cents / qty).cast("bigint")
    yield_txt = _dec(v.cast("decimal(14,0)") / 100, 14)
    return lines.select(
        *[c.alias(name) for c, name in zip(_page_keys(), ("page_id", "page_part"))],
        F.when(F.col("l_discount") == 0.07, _dec(-F.col("l_quantity")))
        .when(F.col("l_discount") == 0.08, F.concat(F.lit("-"), (cents * 7).cast("string"), F.lit(".5")))
        .when(F.col("l_discount") == 0.1, F.concat(F.lit("-0.000"), qty.cast("string")))
        .otherwise(_dec(F.col("l_quantity"))).alias("area_"),
        F.when(F.col("l_discount") == 0.03, F.lit(None).cast("string"))
        .when(F.col("l_discount") == 0.04, F.concat(F.lit("  "), F.col("p_brand"), F.lit(" ")))
        .otherwise(F.col("p_brand")).alias("crop"),
        F.when(F.col("l_tax") == 0.05, F.lit(None).cast("string"))
        .when(F.col("l_tax") == 0.06, F.concat(F.lit("FY"), ys))
        .when(F.col("l_tax") == 0.07, F.concat(ys, F.lit("-"), F.lpad(((y + 1) % 100).cast("string"), 2, "0")))
        .otherwise(ys).alias("crop_year"),
        F.when(F.col("l_discount") == 0.09, F.lit(None).cast("string")).otherwise(F.col("n_name")).alias("district_name"),
        _dec(F.col("l_discount"), 4, 2).alias("l_discount"),
        F.col("l_linenumber").cast("string").alias("l_linenumber"),
        F.col("l_linestatus").alias("l_linestatus"),
        F.col("l_orderkey").cast("string").alias("l_orderkey"),
        F.col("l_partkey").cast("string").alias("l_partkey"),
        F.to_date("l_shipdate").cast("string").alias("l_shipdate"),
        F.col("l_suppkey").cast("string").alias("l_suppkey"),
        _dec(F.col("l_tax"), 4, 2).alias("l_tax"),
        _dec(F.col("l_extendedprice")).alias("production_"),
        F.when(F.col("l_returnflag") == "A", "Kharif").when(F.col("l_returnflag") == "N", "Rabi")
        .otherwise("Whole_Year").alias("season"),
        F.col("r_name").alias("state_name"),
        yield_txt.alias("yield"),
        *(extra or []),
    )


def crop_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(page_id, record map) - the typed source rows as text records."""
    f = crop_fields(crop_lines(spark, sf_dir))
    return f.select("page_id", bronze.columns_to_record(RECORD_KEYS).alias("record"))


def page_rows(spark: SparkSession, sf_dir: str, faults: bool = False, portion: tuple[int, int] = (0, 1), by_page: bool = False) -> DataFrame:
    """What the pages hold, a row for each record; with ``faults`` some pages' records have a late field.
    ``by_page``: the lines of a page are together, shuffled as they are in the tables."""
    lines = crop_lines(spark, sf_dir, dealt=True, portion=portion)
    f = crop_fields(lines.repartition(*_page_keys()) if by_page else lines, extra=["l_extendedprice"])
    record = bronze.columns_to_record(RECORD_KEYS)
    if faults:
        wide = F.map_concat(record, F.create_map(F.lit(LATE), F.concat(F.lit("late "), F.col("l_linenumber"))))
        record = F.when(F.col("page_id") % 7 == 3, wide).otherwise(record)
    return f.select("page_id", "page_part", "l_extendedprice", "l_linestatus", record.alias("record"))


ERROR_PRICE = 104500.0  # pages holding a line above this first fail once


CUT_PRICE = 104000.0  # pages holding a line above this (and no error) first come cut off
LATE = "note"  # a field that only some pages' records have


def crop_portions(spark: SparkSession, sf_dir: str, faults: bool = False) -> list[DataFrame]:
    """The pages in as many portions as lineitem's size asks for, each page whole in one of them."""
    n = max(1, -(-load(spark, sf_dir, "lineitem").count() // PORTION_LINES))
    return [crop_pages(spark, sf_dir, faults=faults, portion=(k, n)) for k in range(n)]


def crop_pages(spark: SparkSession, sf_dir: str, run_id: str = "run-0001", faults: bool = False, portion: tuple[int, int] = (0, 1)) -> DataFrame:
    """Landed page envelopes (PAGE schema) - one per page, plus a failed
    attempt (status=error, no records) before pages holding a very large line.

    Line numbers count within an order, so an envelope (``PAGE_DIV`` orders and
    ``PAGE_LINES`` line numbers) gathers at most 80 lines, however long an
    order is. Both kinds of envelope come out of the same aggregation.
    """
    recs = page_rows(spark, sf_dir, faults, portion, by_page=True)
    # dataset size as the source reports it: the source table's row count,
    # answered from Parquet footers (no pass over the data)
    total = load(spark, sf_dir, "lineitem").count()
    fields = F.array(*[
        F.struct(F.lit(k).alias("id"), F.lit(k).alias("name"),
                 F.lit("double" if k in ("area_", "production_", "yield") else "keyword").alias("type"))
        for k in ["state_name", "district_name", "crop_year", "season", "crop", "area_", "production_", "yield"]
    ])
    grouped = recs.groupBy("page_id", "page_part").agg(F.collect_list("record").alias("records"),
                                          F.max("l_extendedprice").alias("mx"))
    ok = F.struct(F.lit(1).alias("attempt"), F.to_json(F.struct(
        F.lit(DATASET_NAME).alias("title"), F.lit("ok").alias("status"),
        F.lit(str(total)).alias("total"), fields.alias("field"), F.col("records"),
    )).alias("raw_json"))
    bad = F.struct(F.lit(0).alias("attempt"), F.to_json(F.struct(
        F.lit("error").alias("status"), F.lit("upstream timeout").alias("error"), F.lit(str(total)).alias("total"),
    )).alias("raw_json"))
    attempts = F.when(F.col("mx") > ERROR_PRICE, F.array(bad, ok)).otherwise(F.array(ok))
    if faults:
        cut = F.struct(F.lit(0).alias("attempt"), F.left(ok.getField("raw_json"), F.lit(60)).alias("raw_json"))
        attempts = F.when((F.col("mx") > CUT_PRICE) & (F.col("mx") <= ERROR_PRICE), F.array(cut, ok)).otherwise(attempts)
    env = grouped.select("page_id", "page_part", F.explode(attempts).alias("a")).select("page_id", "page_part", "a.attempt", "a.raw_json")
    offset = F.col("page_id") * PAGE_DIV
    fetched = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")
    if faults:
        fetched = fetched + F.make_dt_interval(secs=(F.col("page_id") % 1000 / 1000).cast("decimal(18,6)"))
    return env.select(
        F.lit(SOURCE_SYSTEM).alias("source_system"),
        F.lit(RESOURCE_ID).alias("resource_id"),
        F.lit(run_id).alias("run_id"),
        offset.cast("bigint").alias("offset"),
        F.lit(PAGE_DIV).cast("int").alias("limit"),
        F.concat(F.lit(BASE_URL), F.lit("?offset="), offset.cast("string"), F.lit("&limit="), F.lit(str(PAGE_DIV))).alias("request_url"),
        F.create_map(F.lit("api-key"), F.lit("secret-key"), F.lit("format"), F.lit("json"),
                     F.lit("offset"), offset.cast("string"), F.lit("limit"), F.lit(str(PAGE_DIV))).alias("request_params"),
        "raw_json",
        fetched.alias("fetched_at"),
        "attempt",
    )


def ingest(pages: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Pages -> bronze (map payload): error pages quarantined, records
    exploded, hashed and merged on the hash."""
    good, _bad = records.split_error_pages(pages)
    recs = records.explode_records(good, keep=["offset", "attempt", "fetched_at"])
    recs = bronze.enrich(recs, source_dataset=DATASET_NAME, source_resource_id=RESOURCE_ID,
                         source_system=SOURCE_SYSTEM)
    recs = recs.withColumn("ingested_at", F.col("fetched_at"))
    return bronze.bronze_upsert(existing, recs, seq=["offset", "attempt", "record_no"])


def crop_bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest(crop_pages(spark, sf_dir))


def crop_silver(spark: SparkSession, sf_dir: str, by_map: bool = False, dealt: bool = False) -> DataFrame:
    """Silver rows, straight from the table rows. By default by an ordered
    select, as their fields are known; ``by_map=True`` goes through record maps
    of any fields (the same result)."""
    if by_map:
        recs = crop_records(spark, sf_dir)
        return silver.silver_map(recs.withColumn("source_record_hash", record_hash(F.col("record"))))
    f = crop_fields(crop_lines(spark, sf_dir, dealt))
    f = f.withColumn("source_record_hash", struct_hash(*RECORD_KEYS))
    return silver.silver_select(f, RECORD_KEYS)


# ---------------------------------------------------------------- oracle SQL

CROP_FIELDS_SQL = """
SELECT
  CAST(l_orderkey // 20 AS BIGINT) AS page_id,
  CASE WHEN l_discount = 0.07 THEN CAST(CAST(-l_quantity AS DECIMAL(12,2)) AS VARCHAR)
       WHEN l_discount = 0.08 THEN '-' || CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 7 AS VARCHAR) || '.5'
       WHEN l_discount = 0.1 THEN '-0.000' || CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)
       ELSE CAST(CAST(l_quantity AS DECIMAL(12,2)) AS VARCHAR) END AS area_,
  CASE WHEN l_discount = 0.03 THEN NULL
       WHEN l_discount = 0.04 THEN '  ' || p_brand || ' '
       ELSE p_brand END AS crop,
  CASE WHEN l_tax = 0.05 THEN NULL
       WHEN l_tax = 0.06 THEN 'FY' || CAST(year(l_shipdate) AS VARCHAR)
       WHEN l_tax = 0.07 THEN CAST(year(l_shipdate) AS VARCHAR) || '-' || lpad(CAST((year(l_shipdate) + 1) % 100 AS VARCHAR), 2, '0')
       ELSE CAST(year(l_shipdate) AS VARCHAR) END AS crop_year,
  CASE WHEN l_discount = 0.09 THEN NULL ELSE n_name END AS district_name,
  CAST(CAST(l_discount AS DECIMAL(4,2)) AS VARCHAR) AS l_discount,
  CAST(l_linenumber AS VARCHAR) AS l_linenumber,
  l_linestatus,
  CAST(l_orderkey AS VARCHAR) AS l_orderkey,
  CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate,
  CAST(l_suppkey AS VARCHAR) AS l_suppkey,
  CAST(CAST(l_tax AS DECIMAL(4,2)) AS VARCHAR) AS l_tax,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS production_,
  CASE l_returnflag WHEN 'A' THEN 'Kharif' WHEN 'N' THEN 'Rabi' ELSE 'Whole_Year' END AS season,
  r_name AS state_name,
  CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) // 100 AS VARCHAR) || '.' ||
    lpad(CAST((CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT)) % 100 AS VARCHAR), 2, '0') AS yield
FROM lineitem
JOIN part ON l_partkey = p_partkey
JOIN supplier ON l_suppkey = s_suppkey
JOIN nation ON s_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
"""

CROP_HASH_SQL = (
    "sha256(to_json(MAP {"
    + ", ".join(f"'{k}': {k}" for k in RECORD_KEYS)
    + "}))"
)

_STRIP = "regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"

_LATE_MAP = ", ".join(f"'{k}': {k}" for k in sorted([*RECORD_KEYS, "note"]))
LATE_HASH_SQL = f"CASE WHEN note IS NULL THEN {CROP_HASH_SQL} ELSE sha256(to_json(MAP {{{_LATE_MAP}}})) END"
LATE_FIELDS_SQL = f"""SELECT *, CASE WHEN page_id % 7 = 3 THEN 'late ' || l_linenumber END AS note FROM ({CROP_FIELDS_SQL}) c"""

CROP_SILVER_SQL = f"""
SELECT
  {_STRIP.format(c='state_name')} AS state_name,
  {_STRIP.format(c='district_name')} AS district_name,
  {_STRIP.format(c='crop')} AS crop_name,
  {_STRIP.format(c='season')} AS season,
  {_STRIP.format(c='crop_year')} AS year,
  CAST(area_ AS DOUBLE) AS area_hectare,
  CAST(production_ AS DOUBLE) AS production_tonnes,
  CAST(yield AS DOUBLE) AS yield_ton_per_hectare,
  {CROP_HASH_SQL} AS source_record_hash
FROM ({CROP_FIELDS_SQL}) f
"""
