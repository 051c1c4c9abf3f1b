"""The ingest chain over landed pages: routing, records, catalogue, evolved
bronze, metrics and rejects, from one pass over the pages."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import bronze, ledger, records
from granary.session import release, scratch_path, shared_dir
from granary.sinks.keyed_table import BUCKETS, PACKED, SLOTS, KeyedTable, Stage, stage

_TEXT = T.StringType()
BRONZE = T.StructType(
    [T.StructField(c, T.TimestampNTZType() if c == "ingested_at" else _TEXT) for c in bronze.LINEAGE_COLUMNS]
    + [T.StructField("record", T.MapType(_TEXT, _TEXT))])


@dataclass
class Ingested:
    bronze: KeyedTable  # lineage columns and the record map, one row per hash
    catalogue: DataFrame  # dataset_id, field_name, field_type, discovered_at
    table: DataFrame  # bronze with one text column per catalogued field
    rejects: DataFrame  # a failed job per quarantined page
    metrics: DataFrame  # one row per run


def bronze_table(spark: SparkSession, path: str, slots: int = SLOTS, buckets: int = BUCKETS) -> KeyedTable:
    """The bronze table in ``path``: bucketed by the record hash, merged into slot by slot."""
    return KeyedTable(spark, path, BRONZE, "source_record_hash", slots, buckets)


def _with_lineage(recs: DataFrame, dataset: str, resource: str, system: str) -> DataFrame:
    recs = bronze.enrich(recs, source_dataset=dataset, source_resource_id=resource, source_system=system)
    return recs.withColumn("ingested_at", F.col("fetched_at"))


def page_records(pages: DataFrame, *, dataset: str, resource: str, system: str) -> tuple[DataFrame, DataFrame]:
    """(records with lineage columns, quarantined pages)."""
    good, bad = records.split_error_pages(pages)
    recs = records.explode_records(good, keep=["run_id", "offset", "attempt", "fetched_at"])
    return _with_lineage(recs, dataset, resource, system), bad


def _per_run(column: Column, name: str) -> tuple[Column, Column]:
    return F.min(column).alias(f"min_{name}"), F.max(column).alias(f"max_{name}")


@dataclass
class Landed:
    records: DataFrame  # run_id, offset, attempt, fetched_at, record_no, record, lineage columns
    rejects: DataFrame  # quarantined pages: run_id, offset, attempt, fetched_at, reason, raw_json
    seen: dict  # pages, failed, records, min_/max_ of run_id and fetched_at
    stage: Stage | None = None  # the records in the pieces of a table


def land(pages: DataFrame | list[DataFrame], *, dataset: str, resource: str, system: str, table: KeyedTable | None = None) -> Landed:
    """Pages routed, parsed, hashed and written once; the counts are observed on that write. Portions of pages are
    written one after the other, so that the disk has the shuffles of one only. With ``table`` the records lie in the
    pieces in which they are merged into it."""
    portions = pages if isinstance(pages, list) else [pages]
    spark = portions[0].sparkSession
    path = scratch_path(spark, "records")
    keep = ["run_id", "offset", "attempt", "fetched_at"]
    seen, staged = [], None
    for portion in portions:
        watch = Observation()
        rows = _with_lineage(_routed(portion, watch), dataset, resource, system)
        if table is not None:
            staged = stage(rows, F.when(F.col("record").isNotNull(), table.piece_of()).otherwise(F.lit(-1)), path)
        else:
            rows.write.mode("append").options(**PACKED).parquet(path)
        seen.append(watch.get)
        release(spark)
    records, rejects = (staged.read(), staged.read([-1])) if staged else [spark.read.parquet(path)] * 2
    return Landed(
        records.where(F.col("record").isNotNull()).drop("reason", "raw_json"),
        rejects.where(F.col("reason").isNotNull()).select(*keep, "reason", "raw_json"), _in_all(seen), staged)


def _in_all(seen: list[dict]) -> dict:
    """The counts of several writes together."""
    said = {k: [s[k] for s in seen if s[k] is not None] for k in seen[0]}
    kinds = {"min": lambda v: min(v, default=None), "max": lambda v: max(v, default=None)}
    return {k: kinds.get(k[:3], sum)(v) for k, v in said.items()}


def _routed(pages: DataFrame, watch: Observation) -> DataFrame:
    """A row per record, and one for each page without any."""
    routed = pages.select("run_id", "offset", "attempt", "fetched_at", "raw_json", records.page_reason(F.col("raw_json")).alias("reason"))
    env = records.parse_envelope(routed.withColumn("text", F.when(F.col("reason").isNull(), F.col("raw_json"))), "text")
    env = env.withColumn("records", F.col("env.records"))
    env = env.withColumn("reason", F.coalesce("reason", records.records_reason(F.col("raw_json"), F.col("records"))))
    env = env.observe(
        watch, F.count(F.lit(1)).alias("pages"), F.count_if(F.col("reason").isNotNull()).alias("failed"),
        F.coalesce(F.sum(F.when(F.col("reason").isNull(), F.size("records"))), F.lit(0)).alias("records"),
        *_per_run(F.col("run_id"), "run_id"), *_per_run(F.col("fetched_at"), "fetched_at"))
    return env.select(
        "run_id", "offset", "attempt", "fetched_at", "reason", F.when(F.col("reason").isNotNull(), F.col("raw_json")).alias("raw_json"),
        F.posexplode_outer(F.when(F.col("reason").isNull(), F.col("records"))).alias("record_no", "record"))


def ingest(pages: DataFrame | list[DataFrame], table: KeyedTable, catalogue: DataFrame, *, dataset: str, resource: str, system: str,
           seq: list[str] | None = None) -> Ingested:
    """Pages into a bronze table.

    Malformed, failed and empty pages are set aside as failed jobs. New fields
    enter the catalogue with the time of the first page that has them, and the
    table is widened by them; rows from before have NULL there. The pages are
    read and parsed once; the merge rewrites the touched slots only. A batch's
    counts are observed on these two writes; only for a batch of several runs
    are they grouped from the written records, which otherwise leave the disk as they are merged.
    """
    seq = seq or ["offset", "attempt", "record_no"]
    landed = land(pages, dataset=dataset, resource=resource, system=system, table=table)
    spark = table.spark
    known = catalogue.where((F.col("dataset_id") == resource) & F.col("field_name").isNotNull()).select("field_name").distinct()
    names, listed = F.map_keys("record"), [F.lit(r["field_name"]) for r in known.collect()]
    found = landed.records.select(
        F.lit(resource).alias("dataset_id"), F.explode(F.array_except(names, F.array(*listed)) if listed else names).alias("field_name"),
        F.col("fetched_at").alias("discovered_at"), *seq)
    shared_dir(spark)
    widened = bronze.catalogue_upsert(catalogue, found, seq=seq).checkpoint()
    before = table.snapshot()
    landed.stage.keep = landed.seen["min_run_id"] != landed.seen["max_run_id"]
    merged = bronze.merge_into(table, landed.stage, seq=seq)
    fields = [r["field_name"] for r in widened.where(F.col("dataset_id") == resource).select("field_name").collect()]
    wide = bronze.promote_record(table.read(), fields)  # fields: one per column
    seen = landed.seen
    if seen["min_run_id"] == seen["max_run_id"]:
        metrics = ledger.observed_metrics(spark, seen, merged)
    else:
        metrics = ledger.batch_metrics(_page_rows(landed), _run_counts(landed.records, table.read(at=before)))
    return Ingested(table, widened, wide, records.failed_jobs(landed.rejects), metrics)


def _page_rows(landed: Landed) -> DataFrame:
    """Rows for :func:`ledger.batch_metrics`: what each run's written records and rejects add up to. A page
    without records counts by its failure only."""
    good = landed.records.groupBy("run_id", "fetched_at").agg(F.count(F.lit(1)).alias("n_records"))
    good = good.select("run_id", "n_records", F.lit(False).alias("is_error"), "fetched_at")
    return good.unionByName(landed.rejects.select("run_id", F.lit(0).cast("bigint").alias("n_records"), F.lit(True).alias("is_error"), "fetched_at"))


def _run_counts(recs: DataFrame, before: DataFrame) -> DataFrame:
    hashes = recs.select("run_id", "source_record_hash").distinct()
    known = before.select("source_record_hash", F.lit(True).alias("known"))
    return hashes.join(known, "source_record_hash", "left").groupBy("run_id").agg(
        F.count_if(F.col("known").isNull()).alias("new"), F.count_if(F.col("known").isNotNull()).alias("old"))
