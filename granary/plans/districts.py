"""District-change events derived from the driver tables.

Layouts (as the event CSVs carry them):
  new district: customer -> State/UT = region, Old districts = nation,
                New District = customer name, Year = 1990 + nation key
                (blank when the balance is negative);
  split:        supplier -> District-Before = nation, District-After = supplier;
  rename:       part -> State/UT = type, Old Name = part name,
                New Name = name + brand, Decade = "YYYY-YYYY" or "YYYY".
MERGER events: one per order; parents = distinct supplier nations of its
lines (a bounded group), child = customer nation; status 'P' orders carry an
unknown type and yield no edge. Aliases: region-0 nations -> "REGION-key".
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.text import title_case
from granary.operators import lineage
from granary.plans.tables import load

FILES = [("new_districts.csv", "https://files.example/new_districts.csv"),
         ("splits.csv", "https://files.example/splits.csv"),
         ("renames.csv", "https://files.example/renames.csv"),
         ("orders.csv", "https://files.example/orders.csv")]
URL = dict(FILES)


def _geo(spark, sf_dir):
    nation = load(spark, sf_dir, "nation")
    region = load(spark, sf_dir, "region")
    return nation, region


def layout_frames(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The three event layouts with their CSV headers (all text)."""
    nation, region = _geo(spark, sf_dir)
    cust = load(spark, sf_dir, "customer")
    supp = load(spark, sf_dir, "supplier")
    part = load(spark, sf_dir, "part")
    # its size is estimated as the product of the two tables', larger than customer, which would be broadcast by nation
    nr = F.broadcast(nation.join(region, nation.n_regionkey == region.r_regionkey))
    l1 = cust.join(nr, cust.c_nationkey == nr.n_nationkey).select(
        F.col("r_name").alias("State/UT"), F.col("n_name").alias("Old districts"),
        F.col("c_name").alias("New District"),
        F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string"))
        .otherwise((F.col("c_nationkey") + 1990).cast("string")).alias("Year"),
        F.lit("new_districts.csv").alias("source_document"), F.lit(URL["new_districts.csv"]).alias("source_url"),
    )
    l2 = supp.join(nr, supp.s_nationkey == nr.n_nationkey).select(
        F.col("r_name").alias("State/UT"), F.col("n_name").alias("District-Before"),
        F.col("s_name").alias("District-After"), (F.col("s_nationkey") + 2000).cast("string").alias("Year"),
        F.lit("splits.csv").alias("source_document"), F.lit(URL["splits.csv"]).alias("source_url"),
    )
    start = (F.col("p_size") + 1950).cast("string")
    l3 = part.select(
        F.col("p_type").alias("State/UT"), F.col("p_name").alias("Old Name"),
        F.concat(F.col("p_name"), F.lit(" "), F.col("p_brand")).alias("New Name"),
        F.when(F.col("p_size") > 45, start)
        .otherwise(F.concat(start, F.lit("-"), (F.col("p_size") + 1960).cast("string"))).alias("Decade"),
        F.lit("renames.csv").alias("source_document"), F.lit(URL["renames.csv"]).alias("source_url"),
    )
    return [l1, l2, l3]


def aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = _geo(spark, sf_dir)
    return nation.join(region, nation.n_regionkey == region.r_regionkey).where(F.col("n_regionkey") == 0).select(
        title_case(F.col("n_name")).alias("alias"),
        F.concat(F.col("r_name"), F.lit("-"), F.col("n_nationkey").cast("string")).alias("canonical"),
    )


def layout_events(spark: SparkSession, sf_dir: str, with_aliases: bool = True) -> DataFrame:
    a = aliases(spark, sf_dir) if with_aliases else None
    frames = layout_frames(spark, sf_dir)
    evs = [lineage.events_from_layout(f, lineage.layout_of(f.columns), a) for f in frames]
    return lineage.event_union(evs)


def merger_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, _ = _geo(spark, sf_dir)
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    supp = load(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    sn = nation.select(F.col("n_nationkey").alias("sn_key"), F.col("n_name").alias("sn_name"))
    parents = (li.join(supp, li.l_suppkey == supp.s_suppkey)
               .join(sn, F.col("s_nationkey") == F.col("sn_key"))
               .groupBy("l_orderkey")
               .agg(F.concat_ws(",", F.array_sort(F.collect_set("sn_name"))).alias("parent_district")))
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority",
                                                  "o_orderdate")
    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    cn = nation.select(F.col("n_nationkey").alias("cn_key"), F.col("n_name").alias("cn_name"))
    # customer grows with orders: its compressed file is no measure of its rows in the driver
    o = (orders.join(cust.hint("merge"), orders.o_custkey == cust.c_custkey)
         .join(cn, F.col("c_nationkey") == F.col("cn_key"))
         .join(parents, F.col("o_orderkey") == F.col("l_orderkey")))
    return o.select(
        F.col("o_orderpriority").alias("state"), "parent_district", F.col("cn_name").alias("child_district"),
        F.when(F.col("o_orderstatus") == "P", "ANNEXATION").otherwise("MERGER").alias("event_type"),
        F.lit(None).cast("date").alias("effective_date"),
        F.year("o_orderdate").cast("string").alias("effective_year"),
        F.lit(None).cast("date").alias("notification_date"),
        F.lit("orders.csv").alias("source_document"), F.lit(URL["orders.csv"]).alias("source_url"),
        F.lit("").alias("remarks"),
    )


def all_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return layout_events(spark, sf_dir).unionByName(merger_events(spark, sf_dir))


def directory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reference names: nation names (region-1 ones with one letter edited)
    and customer names (BUILDING ones with one letter edited)."""
    nation = load(spark, sf_dir, "nation")
    cust = load(spark, sf_dir, "customer")
    n = nation.select(F.when(F.col("n_regionkey") == 1, F.regexp_replace("n_name", "O", "0"))
                      .otherwise(F.col("n_name")).alias("name"))
    c = cust.select(F.when(F.col("c_mktsegment") == "BUILDING", F.regexp_replace("c_name", "Customer#", "Custemer#"))
                    .otherwise(F.col("c_name")).alias("name"))
    return n.unionByName(c)


# ---------------------------------------------------------------- oracle SQL

def title_sql(x: str) -> str:
    return ("array_to_string(list_transform(regexp_extract_all(lower(" + x + "), '(\\p{L}*\\P{L}*)', 1), "
            "lambda t: upper(left(t, 1)) || substr(t, 2)), '')")


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^\\s+|\\s+$', '', 'g')"


ALIAS_SQL = (f"SELECT {title_sql('n_name')} AS alias, r_name || '-' || CAST(n_nationkey AS VARCHAR) AS canonical "
             "FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_regionkey = 0")


def clean_sql(x: str, alias: bool = True) -> str:
    t = title_sql(strip_sql(x))
    if alias:
        t = f"coalesce((SELECT canonical FROM ({ALIAS_SQL}) a WHERE a.alias = {t}), {t})"
    return f"CASE WHEN {x} IS NULL OR {x} = '' THEN '' ELSE {t} END"


def _blank(x: str) -> str:
    return f"CASE WHEN {x} IS NULL OR {strip_sql(x)} = '' OR lower({strip_sql(x)}) = 'nan' THEN NULL ELSE {x} END"


LAYOUT_EVENTS_SQL = f"""
SELECT r_name AS state, {clean_sql('n_name')} AS parent_district, {clean_sql('c_name')} AS child_district,
  'NEW_DISTRICT' AS event_type, CAST(NULL AS DATE) AS effective_date,
  {_blank("CASE WHEN c_acctbal < 0 THEN NULL ELSE CAST(c_nationkey + 1990 AS VARCHAR) END")} AS effective_year,
  CAST(NULL AS DATE) AS notification_date, 'new_districts.csv' AS source_document,
  '{URL["new_districts.csv"]}' AS source_url, '' AS remarks
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT r_name, {clean_sql('n_name')}, {clean_sql('s_name')}, 'SPLIT', NULL, CAST(s_nationkey + 2000 AS VARCHAR), NULL,
  'splits.csv', '{URL["splits.csv"]}', ''
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT p_type, {clean_sql('p_name')}, {clean_sql("p_name || ' ' || p_brand")}, 'RENAME', NULL,
  split_part(CASE WHEN p_size > 45 THEN CAST(p_size + 1950 AS VARCHAR)
    ELSE CAST(p_size + 1950 AS VARCHAR) || '-' || CAST(p_size + 1960 AS VARCHAR) END, '-', 1),
  NULL, 'renames.csv', '{URL["renames.csv"]}', ''
FROM part
"""

MERGER_EVENTS_SQL = f"""
SELECT o_orderpriority AS state, p.parent_district, cn.n_name AS child_district,
  CASE WHEN o_orderstatus = 'P' THEN 'ANNEXATION' ELSE 'MERGER' END AS event_type,
  CAST(NULL AS DATE) AS effective_date, CAST(year(o_orderdate) AS VARCHAR) AS effective_year,
  CAST(NULL AS DATE) AS notification_date, 'orders.csv' AS source_document,
  '{URL["orders.csv"]}' AS source_url, '' AS remarks
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation cn ON c_nationkey = cn.n_nationkey
JOIN (SELECT l_orderkey, string_agg(DISTINCT sn.n_name, ',' ORDER BY sn.n_name) AS parent_district
      FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation sn ON s_nationkey = sn.n_nationkey
      GROUP BY l_orderkey) p ON o_orderkey = p.l_orderkey
"""

ALL_EVENTS_SQL = f"{LAYOUT_EVENTS_SQL}\nUNION ALL\n{MERGER_EVENTS_SQL}"

EDGES_SQL = f"""SELECT DISTINCT * FROM (
  SELECT parent_district AS source_district, child_district AS target_district, event_type, effective_year, state,
    source_document AS source
  FROM ({ALL_EVENTS_SQL}) e WHERE event_type IN ('SPLIT', 'NEW_DISTRICT', 'BOUNDARY_TRANSFER', 'RENAME')
  UNION ALL
  SELECT {clean_sql('p')} AS source_district, child_district, event_type, effective_year, state, source_document
  FROM (SELECT unnest(string_split(coalesce(parent_district, 'None'), ',')) AS p, * FROM ({ALL_EVENTS_SQL}) e
        WHERE event_type = 'MERGER') m
  WHERE {strip_sql('p')} <> ''
) x"""

DIRECTORY_SQL = """SELECT CASE WHEN n_regionkey = 1 THEN replace(n_name, 'O', '0') ELSE n_name END AS name FROM nation
UNION ALL
SELECT CASE WHEN c_mktsegment = 'BUILDING' THEN replace(c_name, 'Customer#', 'Custemer#') ELSE c_name END FROM customer"""
