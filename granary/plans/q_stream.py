"""Streaming keys: landing folders are filled from the driver tables, then a
stream runs with ``availableNow`` and the written batches are read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.hashing import record_hash
from granary.operators import bronze
from granary.plans import pages
from granary.plans.crop import crop_silver
from granary.plans.q_quality import DQ_ALL_SQL, SILVER_CTE
from granary.plans.registry import query
from granary.plans.tables import load
from granary.session import scratch_path
from granary.sinks.writers import TS_NTZ_FORMAT
from granary.sources.files import LANDED_PAGE
from granary.streaming import ingest

EVENTS_SQL = "SELECT event_id, ts, user_id, event_type, value, props FROM events"
EVENT_COLS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def _hashed_events(df):
    rec = bronze.columns_to_record(EVENT_COLS)
    return df.withColumn("source_record_hash", record_hash(rec))


def _land(df, path, parts: int | None = None):
    """Files of a landing folder: one per task, or ``parts`` (more if the table's scan has more splits)."""
    df = df if parts is None else df.repartition(max(parts, df.rdd.getNumPartitions()))
    df.write.mode("append").parquet(path)
    return path


STREAM_INGEST_SQL = f"""SELECT o_custkey, o_orderdate, t_orderkey AS o_orderkey, o_orderpriority, o_orderstatus, o_totalprice,
  CASE WHEN (o_orderkey // {pages.PAGE_SIZE}) % 2 = 0 THEN TIMESTAMP '2024-01-02 00:00:00' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS ingested_at,
  'api' AS source_system FROM ({pages.ORDER_TEXT_SQL}) o"""


@query("stream_ingest", STREAM_INGEST_SQL)
def stream_ingest(spark, sf_dir):
    """Landed page files, one per micro-batch. Every second page is fetched
    again a day later, by another system's name, and streamed in a second run:
    its records are refreshed, keep their first lineage and add no row. A
    third run finds no new file and adds nothing."""
    p = pages.orders_pages(spark, sf_dir)
    land = scratch_path(spark, "landing-pages")
    target, ckpt = scratch_path(spark, "bronze-orders"), scratch_path(spark, "ckpt-ingest")

    def land_files(df, parts):
        df.repartition(parts).write.mode("append").option("timestampNTZFormat", TS_NTZ_FORMAT).json(land)

    def run(system):
        stream = ingest.file_stream(spark, land, LANDED_PAGE, "json", 1, {"timestampNTZFormat": TS_NTZ_FORMAT})
        ingest.stream_ingest(stream, target, ckpt, dataset=pages.DATASET_NAME, resource=pages.RESOURCE_ID, system=system)

    land_files(p, 4)
    run("api")
    again = p.where((F.col("offset") / pages.PAGE_SIZE).cast("bigint") % 2 == 0)
    land_files(again.withColumn("fetched_at", F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")), 3)
    run("api-again")
    run("api-again")
    return ingest.read_merged(spark, target).select(*pages.record_columns(spark.range(0)), "ingested_at", "source_system")


@query("stream_dedup", EVENTS_SQL)
def stream_dedup(spark, sf_dir):
    ev = load(spark, sf_dir, "events").select(*EVENT_COLS)
    land = scratch_path(spark, "landing-dup")
    _land(ev, land, parts=4)
    _land(ev, land, parts=3)  # every event lands twice, in different files; each file is a micro-batch
    target, ckpt = scratch_path(spark, "dedup-events"), scratch_path(spark, "ckpt-dedup")
    s = _hashed_events(ingest.file_stream(spark, land, ev.schema, max_files_per_trigger=1))
    ingest.stream_dedup(s, target, ckpt, "source_record_hash")
    return ingest.read_batches(spark, target).select(*EVENT_COLS)


@query("stream_dq", SILVER_CTE + DQ_ALL_SQL)
def stream_dq(spark, sf_dir):
    silver = crop_silver(spark, sf_dir, dealt=True)
    land = _land(silver, scratch_path(spark, "landing-silver"))
    target, ckpt = scratch_path(spark, "issues"), scratch_path(spark, "ckpt-dq")
    ingest.write_batches(ingest.stream_dq(ingest.file_stream(spark, land, silver.schema)), target, ckpt)
    return ingest.read_batches(spark, target)

