"""Run/job bookkeeping kept as data: ledgers, status, resume plans, metrics,
and the incremental-download skip rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INCOMPLETE = ["pending", "running", "failed"]


def job_status_counts(jobs: DataFrame) -> DataFrame:
    """total, completed, failed, pending, running_or_crashed - one pass."""
    s = F.col("status")
    return jobs.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(s == "completed").alias("completed"),
        F.count_if(s == "failed").alias("failed"),
        F.count_if(s == "pending").alias("pending"),
        F.count_if(s == "running").alias("running_or_crashed"),
    )


def job_health(jobs: DataFrame) -> DataFrame:
    return jobs.groupBy("status").agg(F.count(F.lit(1)).alias("job_count"))


def incomplete_jobs(jobs: DataFrame, run_id: str) -> DataFrame:
    return jobs.where((F.col("run_id") == run_id) & F.col("status").isin(INCOMPLETE)).orderBy("offset_value")


def job_ledger(attempts: DataFrame, seq: list[str]) -> DataFrame:
    """(run_id, offset) -> state of the latest attempt, first start time and
    attempt count; one row per key (partial aggregation)."""
    order = F.struct(*[F.col(c) for c in seq])
    return attempts.groupBy("run_id", "offset_value").agg(
        F.max_by(F.struct("status", "records_fetched", "completed_at", "error_message"), order).alias("last"),
        F.min("started_at").alias("started_at"),
        F.count(F.lit(1)).alias("attempts"),
    ).select("run_id", "offset_value", "last.status", "last.records_fetched", "started_at",
             "last.completed_at", "last.error_message", "attempts")


def run_ledger(jobs: DataFrame) -> DataFrame:
    """One row per run derived from its jobs. A run is completed only when
    every job is (trap T10); with work left it is running, else failed."""
    s = F.col("status")
    return jobs.groupBy("run_id").agg(
        F.min("started_at").alias("started_at"),
        F.max("completed_at").alias("completed_at"),
        F.count(F.lit(1)).alias("jobs"),
        F.bool_and(s == "completed").alias("_all_done"),
        F.bool_or(s.isin("pending", "running")).alias("_open"),
    ).select(
        "run_id", "started_at",
        F.when(F.col("_all_done"), F.col("completed_at")).alias("completed_at"),
        "jobs",
        F.when(F.col("_all_done"), "completed").when(F.col("_open"), "running").otherwise("failed").alias("status"),
    )


def latest_incomplete_run(runs: DataFrame, fresh_id: str | None = None) -> DataFrame:
    """Newest run whose status is not completed (ties: larger run_id). Where
    there is none, one row for a run to start: ``fresh_id`` (a new UUID when
    not given), without a start time."""
    fresh = F.lit(fresh_id) if fresh_id is not None else F.expr("uuid()")
    kind = runs.schema["started_at"].dataType
    return runs.where(F.col("status") != "completed").agg(
        F.max_by(F.struct("run_id", "started_at"), F.struct("started_at", "run_id")).alias("r")
    ).select(F.coalesce("r.run_id", fresh).alias("run_id"), F.col("r.started_at").cast(kind).alias("started_at"))


def resume_frontier(jobs: DataFrame, limit: int | Column, runs: DataFrame | None = None) -> DataFrame:
    """Per run: max offset + limit; 0 for a run of ``runs`` without jobs."""
    lim = limit if isinstance(limit, Column) else F.lit(limit)
    last = jobs.groupBy("run_id").agg((F.max("offset_value") + lim).alias("next_offset"))
    if runs is not None:
        last = runs.select("run_id").distinct().join(last, "run_id", "left")
    return last.select("run_id", F.coalesce("next_offset", F.lit(0)).cast("bigint").alias("next_offset"))


def elapsed_seconds(start: Column, end: Column) -> Column:
    """Seconds between two times, with their fraction."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1e6)


def offset_plan(spark: SparkSession, total: int, limit: int, partitions: int | None = None) -> DataFrame:
    """Offsets 0, limit, 2*limit ... < total, generated in parallel."""
    if limit <= 0:
        raise ValueError("limit must be positive")
    return spark.range(0, total, limit, numPartitions=partitions).select(F.col("id").alias("offset_value"))


def resume_plan(planned: DataFrame, jobs: DataFrame, run_id: str) -> DataFrame:
    """Planned offsets without a completed job in the run - covers retries of
    incomplete jobs, offsets beyond the frontier and gaps alike."""
    done = (jobs.where((F.col("run_id") == run_id) & (F.col("status") == "completed"))
            .select("offset_value").distinct())  # a hot offset collapses map-side
    return planned.join(done, "offset_value", "left_anti")


def unfinished(planned: DataFrame, attempts: DataFrame) -> DataFrame:
    """Planned (run_id, offset_value) without a completed attempt in the same run."""
    done = attempts.where(F.col("status") == "completed").select("run_id", "offset_value").distinct()
    return planned.join(done, ["run_id", "offset_value"], "left_anti")


def manifest_skip(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Download decision per listed URL.

    Skip when the URL is in the manifest, the local file exists, and either
    the remote size is known (> 0) and equals the local size, or the recorded
    size equals the local size.
    """
    m = manifest.select(F.col("source_url").alias("url"), F.col("file_size").alias("recorded_size"),
                        F.lit(True).alias("in_manifest"))
    j = listing.join(m, "url", "left")
    local = F.col("local_size")
    skip = (
        F.coalesce(F.col("in_manifest"), F.lit(False))
        & F.col("local_exists")
        & (((F.col("remote_size") > 0) & (local == F.col("remote_size")))
           | F.coalesce(F.col("recorded_size") == local, F.lit(False)))
    )
    return j.select(*listing.columns, F.coalesce(skip, F.lit(False)).alias("skip"))


RUN_METRICS = (
    "run_id string, records_fetched bigint, records_inserted bigint, records_updated bigint, records_failed bigint, "
    "duration_seconds double, throughput_per_second double")


def run_metrics(page_rows: DataFrame, merge_rows: DataFrame) -> DataFrame:
    """Per run: fetched, inserted, updated, failed, duration and throughput.

    ``page_rows``: run_id, n_records, is_error, fetched_at (one per page
    attempt). ``merge_rows``: run_id, was_present, in_batch (one per merged
    hash). Both feed one aggregation. Inserted counts new hashes only and
    updated the refreshed ones; failed counts failed page attempts (trap T11).
    """
    p = page_rows.select("run_id", "n_records", "is_error", "fetched_at",
                         F.lit(None).cast("boolean").alias("was_present"), F.lit(None).cast("boolean").alias("in_batch"))
    m = merge_rows.select("run_id", F.lit(None).cast("bigint").alias("n_records"), F.lit(None).cast("boolean").alias("is_error"),
                          F.lit(None).cast("timestamp_ntz").alias("fetched_at"), "was_present", "in_batch")
    a = p.unionByName(m).groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(~F.col("is_error"), F.col("n_records"))), F.lit(0)).cast("bigint").alias("records_fetched"),
        F.count_if(F.col("in_batch") & ~F.col("was_present")).alias("records_inserted"),
        F.count_if(F.col("in_batch") & F.col("was_present")).alias("records_updated"),
        F.count_if(F.col("is_error")).alias("records_failed"),
        elapsed_seconds(F.min("fetched_at"), F.max("fetched_at")).alias("elapsed"),
    )
    return a.select(
        "run_id", "records_fetched", "records_inserted", "records_updated", "records_failed",
        F.round("elapsed", 2).alias("duration_seconds"),
        F.when(F.col("elapsed") > 0, F.round(F.col("records_inserted") / F.col("elapsed"), 2))
        .otherwise(F.lit(0.0)).alias("throughput_per_second"),
    )


def observed_metrics(spark: SparkSession, pages: dict, merged: dict) -> DataFrame:
    """:func:`run_metrics` of a batch of one run from the counts observed on its two writes (``Landed.seen``
    and what ``merge_into`` returns); no row is read again. A batch without pages has no run and no row."""
    if not pages["pages"]:
        return spark.createDataFrame([], RUN_METRICS)
    elapsed = (pages["max_fetched_at"] - pages["min_fetched_at"]).total_seconds()
    one = (pages["min_run_id"], pages["records"], merged["new"], merged["old"], pages["failed"])
    return spark.createDataFrame([(*one, elapsed)], RUN_METRICS.replace("duration_seconds double, throughput_per_second double", "elapsed double")).select(
        "run_id", "records_fetched", "records_inserted", "records_updated", "records_failed",
        F.round("elapsed", 2).alias("duration_seconds"),
        F.when(F.col("elapsed") > 0, F.round(F.col("records_inserted") / F.col("elapsed"), 2)).otherwise(F.lit(0.0)).alias("throughput_per_second"))


def batch_metrics(page_rows: DataFrame, counts: DataFrame) -> DataFrame:
    """:func:`run_metrics` of one batch whose merge is already counted: ``counts``
    has run_id, ``new`` and ``old`` hashes."""
    p = page_rows.groupBy("run_id").agg(
        F.coalesce(F.sum(F.when(~F.col("is_error"), F.col("n_records"))), F.lit(0)).cast("bigint").alias("records_fetched"),
        F.count_if("is_error").alias("records_failed"),
        elapsed_seconds(F.min("fetched_at"), F.max("fetched_at")).alias("elapsed"))
    j = p.join(counts, "run_id", "left").fillna(0, ["new", "old"])
    return j.select(
        "run_id", "records_fetched", F.col("new").alias("records_inserted"), F.col("old").alias("records_updated"),
        "records_failed", F.round("elapsed", 2).alias("duration_seconds"),
        F.when(F.col("elapsed") > 0, F.round(F.col("new") / F.col("elapsed"), 2)).otherwise(F.lit(0.0)).alias("throughput_per_second"))
