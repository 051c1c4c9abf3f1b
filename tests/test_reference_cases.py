"""The reference's own four lineage tests, as DataFrame tests (FIXTURES F1-F4)."""

import json
import os

from pyspark.sql import functions as F

from granary.functions.text import clean_name
from granary.operators import graph, lineage
from granary.schemas import EDGE
from granary.session import scratch_path
from granary.sinks import writers
from granary.sources.files import read_alias_map


def test_clean_district_name(spark, tmp_path):
    alias_file = tmp_path / "aliases.json"
    alias_file.write_text(json.dumps({"Oldname": "NewName"}))
    aliases = read_alias_map(spark, str(alias_file))
    df = spark.createDataFrame([("  some district  ",), ("OldName",), (None,)], "name string")
    out = lineage.clean_with_aliases(df, ["name"], aliases).collect()
    assert [r["name"] for r in out] == ["Some District", "NewName", ""]
    # literal-map form
    lit = df.select(clean_name(F.col("name"), {"Oldname": "NewName"}).alias("n")).collect()
    assert [r["n"] for r in lit] == ["Some District", "NewName", ""]


def test_lineage_edge_generation(spark):
    events = spark.createDataFrame(
        [("StateA", "Dist1", "Dist2", "SPLIT", "2000", "test.csv"),
         ("StateA", "Dist3,Dist4", "Dist5", "MERGER", "2005", "test.csv")],
        "state string, parent_district string, child_district string, event_type string, "
        "effective_year string, source_document string",
    )
    edges = lineage.lineage_edges(events)
    pairs = {(r["source_district"], r["target_district"]) for r in edges.collect()}
    assert edges.count() == 3
    assert pairs == {("Dist1", "Dist2"), ("Dist3", "Dist5"), ("Dist4", "Dist5")}


def test_build_lineage_graph(spark):
    edges = spark.createDataFrame(
        [("A", "B", "SPLIT", "2000", "S", "src", 0)],
        "source_district string, target_district string, event_type string, effective_year string, "
        "state string, source string, seq int")
    nodes = graph.graph_nodes(edges, ["seq"])
    links = graph.graph_edges(edges, ["seq"])
    assert {r["district"] for r in nodes.collect()} == {"A", "B"}
    assert [(r["source_district"], r["target_district"]) for r in links.collect()] == [("A", "B")]
    n, ln = graph.node_link(nodes, links)
    npath, lpath = writers.write_node_link(n, ln, scratch_path(spark, "test-graph"))
    assert spark.read.json(npath).count() == 2
    assert spark.read.json(lpath).count() == 1


def test_circular_dependency_check(spark):
    edges = spark.createDataFrame(
        [("A", "B", "RENAME", "2000", "S", "src"), ("B", "A", "RENAME", "2001", "S", "src")], EDGE)
    report = graph.quality_report(edges).collect()
    assert report
    assert [(r["issue_type"], r["details"]) for r in report] == [("CIRCULAR_LINEAGE", "['A', 'B']")]
    out = writers.write_csv(graph.quality_report(edges), scratch_path(spark, "test-report"))
    back = spark.read.option("header", True).csv(out)
    assert "CIRCULAR_LINEAGE" in {r["issue_type"] for r in back.collect()}
    assert os.path.basename(out)
