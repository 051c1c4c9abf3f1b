"""Graph keys over event-type transitions: for each user, an edge from each
event's type to the type of the user's next event (ts, event_id order).
Five types (one renamed so that it holds an apostrophe) give a dense little
graph with many circuits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import graph
from granary.operators.sequence import successor_pairs
from granary.plans.registry import query
from granary.plans.tables import load

SEQ = ["seq_user", "seq_ts", "seq_id"]


def transition_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("event_type") == "click", F.lit("o'click")).otherwise(F.col("event_type"))
    ev = load(spark, sf_dir, "events").select("user_id", "ts", "event_id", name.alias("event_type"), "value")
    p = successor_pairs(ev, "user_id", ["ts", "event_id"], ["event_type", "value"])
    return p.select(
        F.col("prev.event_type").alias("source_district"),
        F.col("next.event_type").alias("target_district"),
        F.lit("TRANSITION").alias("event_type"),
        F.when(F.col("next.value") < 1.0, F.lit(None).cast("string"))
        .otherwise(F.year("next.ts").cast("string")).alias("effective_year"),
        F.col("user_id").cast("string").alias("state"),
        F.col("next.event_id").cast("string").alias("source"),
        F.col("user_id").alias("seq_user"), F.col("next.ts").alias("seq_ts"), F.col("next.event_id").alias("seq_id"),
    )


EDGES_SQL = """WITH t AS (
  SELECT user_id, event_type AS src, lead(event_type) OVER w AS tgt, lead(ts) OVER w AS nts,
         lead(event_id) OVER w AS nid, lead(value) OVER w AS nval
  FROM (SELECT * REPLACE (CASE WHEN event_type = 'click' THEN 'o''click' ELSE event_type END AS event_type) FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
edges AS (
  SELECT src AS source_district, tgt AS target_district, 'TRANSITION' AS event_type,
    CASE WHEN nval < 1.0 THEN NULL ELSE CAST(year(nts) AS VARCHAR) END AS effective_year,
    CAST(user_id AS VARCHAR) AS state, CAST(nid AS VARCHAR) AS source, user_id, nts, nid
  FROM t WHERE tgt IS NOT NULL)
"""

CYCLES_SQL = """, e AS (SELECT DISTINCT source_district AS src, target_district AS tgt FROM edges),
paths AS (
  WITH RECURSIVE p(root, last, nodes) AS (
    SELECT src, tgt, [src, tgt] FROM e WHERE tgt > src
    UNION ALL
    SELECT p.root, e.tgt, list_append(p.nodes, e.tgt) FROM p JOIN e ON p.last = e.src
    WHERE e.tgt > p.root AND NOT list_contains(p.nodes, e.tgt))
  SELECT * FROM p),
cycles AS (
  SELECT p.nodes AS cycle FROM paths p JOIN e ON p.last = e.src AND e.tgt = p.root
  UNION ALL SELECT [src] FROM e WHERE src = tgt)
"""

# a name that holds an apostrophe is printed in double quotes
CYCLE_ISSUES_SQL = (
    "SELECT 'CIRCULAR_LINEAGE' AS issue_type, '[' || array_to_string(list_transform(cycle, "
    "lambda x: CASE WHEN contains(x, chr(39)) THEN chr(34) || x || chr(34) ELSE chr(39) || x || chr(39) END), ', ') "
    "|| ']' AS details FROM cycles"
)
MISSING_SQL = "SELECT 'MISSING_YEAR' AS issue_type, source_district || ' -> ' || target_district AS details FROM edges WHERE effective_year IS NULL"


@query(
    "graph_edges",
    EDGES_SQL + """SELECT source_district, target_district, event_type, effective_year, source FROM (
  SELECT *, row_number() OVER (PARTITION BY source_district, target_district ORDER BY user_id DESC, nts DESC, nid DESC) AS rn
  FROM edges) x WHERE rn = 1""",
)
def graph_edges(spark, sf_dir):
    return graph.graph_edges(transition_edges(spark, sf_dir), SEQ)


@query(
    "graph_nodes",
    EDGES_SQL + """, ends AS (
  SELECT source_district AS node, 0 AS pos, user_id, nts, nid, state, source FROM edges
  UNION ALL SELECT target_district, 1, user_id, nts, nid, state, source FROM edges)
SELECT node AS district, state, source FROM (
  SELECT *, row_number() OVER (PARTITION BY node ORDER BY user_id, nts, nid, pos) AS rn FROM ends) x WHERE rn = 1""",
)
def graph_nodes(spark, sf_dir):
    return graph.graph_nodes(transition_edges(spark, sf_dir), SEQ)


@query("graph_cycles", EDGES_SQL + CYCLES_SQL + CYCLE_ISSUES_SQL)
def graph_cycles(spark, sf_dir):
    return graph.cycle_issues(transition_edges(spark, sf_dir))


@query("missing_year", EDGES_SQL + MISSING_SQL)
def missing_year(spark, sf_dir):
    return graph.missing_year(transition_edges(spark, sf_dir))


@query("graph_quality_report", EDGES_SQL + CYCLES_SQL + CYCLE_ISSUES_SQL + "\nUNION ALL\n" + MISSING_SQL)
def graph_quality_report(spark, sf_dir):
    return graph.quality_report(transition_edges(spark, sf_dir))
