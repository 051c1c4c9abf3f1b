"""District-lineage keys over events derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.hashing import district_id
from granary.functions.text import clean_name, decade_start, event_label
from granary.operators import lineage
from granary.plans import districts as d
from granary.plans.registry import query
from granary.plans.tables import load

EV = f"WITH ev AS ({d.ALL_EVENTS_SQL})\n"


@query(
    "clean_name",
    f"""SELECT p_partkey, {d.clean_sql('raw', alias=False)} AS clean_name FROM (
  SELECT p_partkey, CASE WHEN p_size < 5 THEN NULL WHEN p_size < 10 THEN ''
    ELSE '  ' || upper(p_name) || ' o''' || p_brand || ' ' END AS raw FROM part) x""",
)
def clean_name_q(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    raw = (F.when(F.col("p_size") < 5, F.lit(None).cast("string")).when(F.col("p_size") < 10, F.lit(""))
           .otherwise(F.concat(F.lit("  "), F.upper("p_name"), F.lit(" o'"), F.col("p_brand"), F.lit(" "))))
    return p.select("p_partkey", clean_name(raw).alias("clean_name"))


@query("alias_lookup", f"SELECT n_nationkey, {d.clean_sql('n_name')} AS district FROM nation")
def alias_lookup(spark, sf_dir):
    n = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("district"))
    return lineage.clean_with_aliases(n, ["district"], d.aliases(spark, sf_dir))


@query("event_union", f"SELECT * FROM ({d.LAYOUT_EVENTS_SQL}) e")
def event_union(spark, sf_dir):
    return d.layout_events(spark, sf_dir)


@query(
    "merger_explode",
    f"""SELECT {d.clean_sql('p')} AS source_district, child_district AS target_district, event_type, effective_year,
  state, source_document AS source
FROM (SELECT unnest(string_split(coalesce(parent_district, 'None'), ',')) AS p, *
      FROM ({d.MERGER_EVENTS_SQL}) e WHERE event_type = 'MERGER') m WHERE {d.strip_sql('p')} <> ''""",
)
def merger_explode(spark, sf_dir):
    ev = d.merger_events(spark, sf_dir).where(F.col("event_type") == lineage.MERGER_TYPE)
    return lineage.lineage_edges(ev, d.aliases(spark, sf_dir), distinct=False)


@query("lineage_edges", d.EDGES_SQL)
def lineage_edges(spark, sf_dir):
    return lineage.lineage_edges(d.all_events(spark, sf_dir), d.aliases(spark, sf_dir))


@query(
    "edge_distinct",
    f"""SELECT DISTINCT parent_district AS source_district, child_district AS target_district, event_type,
  effective_year, state, source_document AS source FROM ({d.LAYOUT_EVENTS_SQL}) e""",
)
def edge_distinct(spark, sf_dir):
    ev = d.layout_events(spark, sf_dir)
    twice = lineage.lineage_edges(ev, distinct=False).unionByName(lineage.lineage_edges(ev, distinct=False))
    return twice.dropDuplicates()


@query(
    "known_event_types",
    EV + "SELECT * FROM ev WHERE event_type IN ('SPLIT', 'NEW_DISTRICT', 'BOUNDARY_TRANSFER', 'RENAME', 'MERGER')",
)
def known_event_types(spark, sf_dir):
    return lineage.known_event_types(d.all_events(spark, sf_dir))


@query(
    "decade_start",
    """SELECT p_partkey, decade, split_part(decade, '-', 1) AS effective_year FROM (
  SELECT p_partkey, CASE WHEN p_size > 45 THEN CAST(p_size + 1950 AS VARCHAR)
    ELSE CAST(p_size + 1950 AS VARCHAR) || '-' || CAST(p_size + 1960 AS VARCHAR) END AS decade FROM part) x""",
)
def decade_start_q(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    start = (F.col("p_size") + 1950).cast("string")
    dec = F.when(F.col("p_size") > 45, start).otherwise(F.concat(start, F.lit("-"), (F.col("p_size") + 1960).cast("string")))
    x = p.select("p_partkey", dec.alias("decade"))
    return x.select("p_partkey", "decade", decade_start(F.col("decade")).alias("effective_year"))


@query(
    "district_id",
    EV + "SELECT state, child_district, left(md5(coalesce(state, '') || '_' || coalesce(child_district, '')), 12) AS district_id FROM ev",
)
def district_id_q(spark, sf_dir):
    ev = d.all_events(spark, sf_dir)
    return ev.select("state", "child_district", district_id(F.col("state"), F.col("child_district")).alias("district_id"))


@query(
    "district_master",
    EV + """SELECT left(md5(coalesce(state, '') || '_' || coalesce(child_district, '')), 12) AS district_id,
  child_district AS district_name, state, parent_district, child_district, event_type, effective_year,
  source_document AS source, 1.0::DOUBLE AS confidence_score FROM ev""",
)
def district_master(spark, sf_dir):
    return lineage.district_master(d.all_events(spark, sf_dir))


@query(
    "event_label",
    f"SELECT source_district, target_district, event_type || ' ' || coalesce(effective_year, 'None') AS event FROM ({d.EDGES_SQL}) x",
)
def event_label_q(spark, sf_dir):
    e = lineage.lineage_edges(d.all_events(spark, sf_dir), d.aliases(spark, sf_dir))
    return e.select("source_district", "target_district",
                    event_label(F.col("event_type"), F.col("effective_year")).alias("event"))


_MANIFEST_VALUES = ", ".join(f"('{f}', '{u}')" for f, u in d.FILES)


@query(
    "event_manifest_join",
    EV + f"""SELECT ev.state, ev.parent_district, ev.child_district, ev.event_type, m.filename, m.url
FROM ev JOIN (VALUES {_MANIFEST_VALUES}) m(filename, url) ON ev.source_document = m.filename""",
)
def event_manifest_join(spark, sf_dir):
    ev = d.all_events(spark, sf_dir).select("state", "parent_district", "child_district", "event_type",
                                            "source_document")
    manifest = spark.createDataFrame(d.FILES, "filename string, url string")
    j = ev.join(manifest, ev.source_document == manifest.filename)  # one row per listed file
    return j.select("state", "parent_district", "child_district", "event_type", "filename", "url")


@query(
    "reference_validate",
    f"""WITH e AS ({d.EDGES_SQL}),
dir AS (SELECT DISTINCT name FROM ({d.DIRECTORY_SQL}) x),
t AS (SELECT DISTINCT target_district AS district FROM e WHERE target_district IS NOT NULL),
best AS (SELECT district, arg_min(name, levenshtein(district, name) * 1000000 + 0) AS ref_name,
           min(levenshtein(district, name)) AS dist
         FROM t, dir WHERE levenshtein(district, name) <= 1 GROUP BY district),
best2 AS (SELECT b.district, b.dist, min(name) AS ref_name FROM best b, dir
          WHERE levenshtein(b.district, dir.name) = b.dist GROUP BY b.district, b.dist)
SELECT e.event_type || ' ' || coalesce(e.effective_year, 'None') AS event, e.target_district AS district,
  b.dist IS NOT NULL AS lgd_match,
  CASE WHEN b.dist IS NULL THEN 0.0 ELSE 1.0 - b.dist / greatest(length(e.target_district), length(b.ref_name)) END AS confidence_score,
  CASE WHEN b.dist IS NULL THEN '{lineage.NO_MATCH_NOTE.format(d=1)}'
       WHEN b.dist = 0 THEN '{lineage.EXACT_NOTE}' ELSE '{lineage.FUZZY_NOTE.format(d=1)}' END AS validation_notes
FROM e LEFT JOIN best2 b ON e.target_district = b.district""",
)
def reference_validate(spark, sf_dir):
    edges = lineage.lineage_edges(d.all_events(spark, sf_dir), d.aliases(spark, sf_dir))
    return lineage.reference_validate(edges, d.directory(spark, sf_dir))
