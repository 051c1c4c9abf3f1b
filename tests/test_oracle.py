"""Registered queries against their DuckDB SQL on the smallest tables.

The full list runs with ``python tests/oracle_harness.py`` (sf0.01); here a
cross-section of every area runs at sf0.001 so the suite stays quick.
"""

import pytest

import __spark_entry__ as entry_mod
from conftest import SMALL
from oracle_harness import compare, duck

SAMPLE = [
    "q_records_per_state", "q_top_crops", "dq_all", "validation_run_summary", "ingest_batch", "page_explode_records",
    "bronze_upsert", "record_hash", "catalogue_upsert", "schema_diff", "flatten_headers", "wide_to_tidy",
    "pivot_metrics", "lineage_edges", "reference_validate", "graph_cycles", "graph_nodes", "run_metrics",
    "resume_plan", "job_ledger", "html_table_rows", "html_link_discovery", "sink_arrow", "src_event_csv",
    "stream_dedup", "stream_ingest", "manifest_skip", "ingest_rejects", "ingest_metrics", "file_manifest", "sink_csv",
    "sink_graph_node_link", "event_csv_rejects", "resume_anti_join", "resume_frontier", "latest_incomplete_run",
    "bronze_stringify", "record_hash_compat",
]


@pytest.fixture(scope="module")
def con():
    return duck(SMALL)


def test_registry_complete():
    q, o = entry_mod.queries(), entry_mod.oracle_sql()
    assert len(q) >= 95
    assert set(o) <= set(q)
    own = {k for k in q if not k.startswith("op") and k != "pipeline"}
    assert own <= set(o)


@pytest.mark.parametrize("key", SAMPLE)
def test_query_matches_oracle(spark, con, key):
    info = compare(spark, con, key, entry_mod.queries()[key], entry_mod.oracle_sql()[key], SMALL)
    assert info["status"] == "OK", info


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    rows = df.collect()
    assert rows and df.columns == ["state_name", "record_count"]
