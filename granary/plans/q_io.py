"""Sink and file-source keys: data is written to a fresh folder under the
session's checkpoint directory and read back; the oracle is the SQL of what
was written."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import graph, lineage, records
from granary.plans import districts as d
from granary.plans import pages, q_lineage, registry  # noqa: F401  (their SQL describes the reports)
from granary.plans.q_graph import EDGES_SQL as TRANSITION_EDGES_SQL
from granary.plans.q_graph import transition_edges, SEQ
from granary.plans.registry import query
from granary.plans.tables import load
from granary.session import scratch_path
from granary.sinks import writers
from granary.sources import files

# the whole table, with texts that an exporter must not alter: padded, empty, NULL, quoted, with line breaks
_NOTE = """CASE event_id % 7 WHEN 0 THEN '  ' || event_type || ' ' WHEN 1 THEN '' WHEN 2 THEN NULL WHEN 3 THEN 'a' || chr(10) || 'b,"c"'
  ELSE event_type END"""
EXPORT_SQL = f"SELECT *, {_NOTE} AS note FROM events"


def _export(spark, sf_dir):
    return load(spark, sf_dir, "events").withColumn("note", F.expr(_NOTE))


@query("sink_csv", EXPORT_SQL)
def sink_csv(spark, sf_dir):
    df = _export(spark, sf_dir)
    path = writers.write_csv(df, scratch_path(spark, "export-csv"))
    return writers.read_csv(spark, path, df.schema)


@query("sink_parquet", EXPORT_SQL)
def sink_parquet(spark, sf_dir):
    df = _export(spark, sf_dir)
    path = writers.write_parquet(df, scratch_path(spark, "export-parquet"))
    return spark.read.parquet(path)


@query("sink_jsonl", EXPORT_SQL)
def sink_jsonl(spark, sf_dir):
    df = _export(spark, sf_dir)
    path = writers.write_jsonl(df, scratch_path(spark, "export-jsonl"))
    return writers.read_jsonl(spark, path, df.schema)


@query("sink_arrow", EXPORT_SQL)
def sink_arrow(spark, sf_dir):
    df = _export(spark, sf_dir)
    path = writers.write_arrow(df, scratch_path(spark, "export-arrow"))
    return writers.read_arrow(spark, path, df.schema)


@query(
    "sink_timestamped_path",
    "SELECT event_id, 'crop_statistics_raw_' || strftime(ts, '%Y%m%d_%H%M%S') || '.csv' AS file_name FROM events",
)
def sink_timestamped_path(spark, sf_dir):
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id", writers.timestamped_name(F.col("ts"), "csv").alias("file_name"))


_PAGES_SQL = f"""SELECT CAST(o_orderkey // 100 * 100 AS BIGINT) AS offset, 1 AS attempt FROM orders GROUP BY 1
UNION ALL SELECT CAST(o_orderkey // 100 * 100 AS BIGINT), 0 FROM orders GROUP BY 1 HAVING max(o_totalprice) > {pages.ERROR_PRICE}"""


@query(
    "sink_raw_dated",
    f"""SELECT 'api' AS source_system, 'run-orders' AS run_id, 2024 AS y, 1 AS m, 1 AS d, p."offset", p.attempt
FROM ({_PAGES_SQL}) p""",
)
def sink_raw_dated(spark, sf_dir):
    path = writers.write_raw_dated(pages.orders_pages(spark, sf_dir), scratch_path(spark, "raw"))
    back = files.read_landed_pages(spark, path)
    return back.select("source_system", "run_id", "y", "m", "d", "offset", "attempt")


@query(
    "src_landed_pages",
    f"""SELECT {"CAST(o_orderkey // 100 * 100 AS BIGINT)"} AS offset, o_custkey, o_orderdate, t_orderkey AS o_orderkey,
  o_orderpriority, o_orderstatus, o_totalprice FROM ({pages.ORDER_TEXT_SQL}) o""",
)
def src_landed_pages(spark, sf_dir):
    path = writers.write_raw_dated(pages.orders_pages(spark, sf_dir), scratch_path(spark, "landed"))
    landed = files.read_landed_pages(spark, path).where((F.col("y") == 2024) & (F.col("m") == 1))
    good, _ = records.split_error_pages(landed)
    r = records.explode_records(good, keep=["offset"])
    return r.select("offset", *pages.record_columns(r))


@query(
    "sink_graph_node_link",
    TRANSITION_EDGES_SQL + """, ends AS (
  SELECT source_district AS node, 0 AS pos, user_id, nts, nid, state, source FROM edges
  UNION ALL SELECT target_district, 1, user_id, nts, nid, state, source FROM edges)
SELECT 'link' AS kind, source_district AS a, target_district AS b, event_type AS c, effective_year AS d, source AS e FROM (
  SELECT *, row_number() OVER (PARTITION BY source_district, target_district ORDER BY user_id DESC, nts DESC, nid DESC) AS rn
  FROM edges) x WHERE rn = 1
UNION ALL SELECT 'node', node, node, state, source, NULL FROM (
  SELECT *, row_number() OVER (PARTITION BY node ORDER BY user_id, nts, nid, pos) AS rn FROM ends) x WHERE rn = 1""",
)
def sink_graph_node_link(spark, sf_dir):
    """Both files of the graph, read back: link rows and node rows."""
    e = transition_edges(spark, sf_dir)
    nodes, links = graph.node_link(graph.graph_nodes(e, SEQ), graph.graph_edges(e, SEQ))
    npath, lpath = writers.write_node_link(nodes, links, scratch_path(spark, "graph"))
    back = writers.read_jsonl(spark, lpath, links.schema).select(
        F.lit("link").alias("kind"), F.col("source").alias("a"), F.col("target").alias("b"), F.col("event_type").alias("c"),
        F.col("effective_year").alias("d"), F.col("source_document").alias("e"))
    return back.unionAll(writers.read_jsonl(spark, npath, nodes.schema).select(
        F.lit("node"), "id", "district", "state", "source", F.lit(None).cast("string")))


def _report_rows(name: str, sql: str, columns: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT '{name}' AS report, {text} AS line FROM ({sql}) r"


EDGE_COLUMNS = ["source_district", "target_district", "event_type", "effective_year", "state", "source"]
MASTER_COLUMNS = ["district_id", "district_name", "state", "parent_district", "event_type", "effective_year", "source"]


@query("sink_reports", "\nUNION ALL\n".join([
    _report_rows("lineage_edges", d.EDGES_SQL, EDGE_COLUMNS),
    _report_rows("district_evolution_master", registry.ORACLE["district_master"], MASTER_COLUMNS),
    _report_rows("lineage_quality_report", registry.ORACLE["graph_quality_report"], ["issue_type", "details"]),
    _report_rows("validation_report", registry.ORACLE["reference_validate"], ["event", "district", "lgd_match", "validation_notes"]),
]))
def sink_reports(spark, sf_dir):
    """All four reports written, read back and shown as lines."""
    events = d.all_events(spark, sf_dir)
    edges = lineage.lineage_edges(events, d.aliases(spark, sf_dir))
    reports = {
        "lineage_edges": (edges, EDGE_COLUMNS),
        "district_evolution_master": (lineage.district_master(events), MASTER_COLUMNS),
        "lineage_quality_report": (graph.quality_report(transition_edges(spark, sf_dir)), ["issue_type", "details"]),
        "validation_report": (lineage.reference_validate(edges, d.directory(spark, sf_dir)),
                              ["event", "district", "lgd_match", "validation_notes"]),
    }
    out = writers.write_reports({k: df for k, (df, _) in reports.items()}, scratch_path(spark, "reports"))
    lines = []
    for name, (df, columns) in reports.items():
        back = writers.read_csv(spark, out[name], df.schema)
        text = F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
        lines.append(back.select(F.lit(name).alias("report"), text.alias("line")))
    return lines[0].unionAll(lines[1]).unionAll(lines[2]).unionAll(lines[3])


def list_files(spark, path: str) -> list[str]:
    """Names of the files directly under ``path`` (file-system metadata only)."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def _land_event_files(spark, sf_dir):
    """Write the three layouts as CSV files the way a harvest leaves them, and
    a manifest listing every file plus a PDF entry, a file of no known layout
    and one that is missing. The first layout comes in two groups of files: one in
    the usual column order, one in another order with a further column, whose
    values hold commas, quotes and line breaks."""
    raw = scratch_path(spark, "event-files")
    names = {"new_district": "new_districts", "split": "splits", "rename": "renames"}
    listed = []

    def land(frame, folder: str, url: str) -> None:
        frame.write.mode("overwrite").option("header", True).option("escape", '"').csv(f"{raw}/{folder}")
        listed.extend((f"{folder}/{n}", url) for n in list_files(spark, f"{raw}/{folder}") if n.endswith(".csv"))

    for f in d.layout_frames(spark, sf_dir):
        lay = lineage.layout_of(f.columns)
        folder = names[lay["name"]]
        url = d.URL[f"{folder}.csv"]
        f = f.drop("source_document", "source_url")
        if lay["name"] == "new_district":
            other = F.crc32(F.col("New District").cast("binary")) % 2 == 0
            land(f.where(~other), folder, url)
            land(f.where(other).select(F.lit('7, "seven"\n(7)\n').alias("Sl No"), "New District", "Old districts", "Year", "State/UT"),
                 f"{folder}_reordered", url)
        else:
            land(f, folder, url)
    land(load(spark, sf_dir, "region").select("r_name"), "regions", "https://files.example/regions.csv")
    listed += [("report.pdf", "https://files.example/report.pdf"), ("missing.csv", "https://files.example/missing.csv")]
    manifest = spark.createDataFrame(listed, "filename string, url string")
    return raw, manifest


EVENT_CSV_COLUMNS = ["state", "parent_district", "child_district", "event_type", "effective_date", "effective_year",
                     "notification_date", "source_url", "remarks"]


@query("src_event_csv", f"SELECT {', '.join(EVENT_CSV_COLUMNS)} FROM ({d.LAYOUT_EVENTS_SQL}) e")
def src_event_csv(spark, sf_dir):
    raw, manifest = _land_event_files(spark, sf_dir)
    ev = files.read_event_csvs(spark, manifest, raw, aliases=d.aliases(spark, sf_dir))
    return ev.select(*EVENT_CSV_COLUMNS)


@query("event_csv_rejects", """SELECT 'missing.csv' AS filename, 'missing or empty' AS reason
UNION ALL SELECT 'regions', 'unknown layout' WHERE EXISTS (SELECT 1 FROM region)""")
def event_csv_rejects(spark, sf_dir):
    raw, manifest = _land_event_files(spark, sf_dir)
    r = files.event_csv_rejects(spark, manifest, raw)
    return r.select(F.substring_index("filename", "/", 1).alias("filename"), "reason").distinct()


@query("src_alias_map", f"SELECT n_nationkey, {d.clean_sql('n_name')} AS district FROM nation")
def src_alias_map(spark, sf_dir):
    a = d.aliases(spark, sf_dir)
    path = scratch_path(spark, "aliases")
    a.select(F.to_json(F.create_map("alias", "canonical")).alias("value")).write.mode("overwrite").text(path)
    back = files.read_alias_map(spark, path, multi_line=False)
    n = load(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("district"))
    return lineage.clean_with_aliases(n, ["district"], back)


@query("file_manifest", """SELECT s_suppkey, sha256(s_name || chr(10)) AS checksum, CAST(strlen(s_name) + 1 AS BIGINT) AS file_size,
  'https://files.example/s' || CAST(s_suppkey AS VARCHAR) AS source_url, '2024-01-01' AS download_date, true AS has_time FROM supplier""")
def file_manifest(spark, sf_dir):
    """One text file per supplier, its checksum and size, and the URL and date from the listing of downloads."""
    supp = load(spark, sf_dir, "supplier")
    raw = scratch_path(spark, "supplier-files")
    # as many tasks as cores, whatever few bytes the rows are; each moves its files in place (version 2), not the driver all of them
    supp.select("s_suppkey", F.col("s_name").alias("value")).repartition(spark.sparkContext.defaultParallelism, "s_suppkey").write.option(
        "mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy("s_suppkey").text(raw)
    m = files.file_manifest(spark, raw, glob="*.txt")
    key = F.regexp_extract("filename", r"s_suppkey=(\d+)/", 1).cast("bigint")
    listing = m.select("filename", F.concat(F.lit("https://files.example/s"), key.cast("string")).alias("source_url"),
                       F.lit("2024-01-01").alias("download_date"))
    m = files.file_manifest(spark, raw, glob="*.txt", listing=listing)
    return m.select(key.alias("s_suppkey"), "checksum", "file_size", "source_url", "download_date",
                    F.col("last_modified").isNotNull().alias("has_time"))
