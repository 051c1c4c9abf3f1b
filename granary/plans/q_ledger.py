"""Bookkeeping keys. Jobs = orders: run_id = o_orderpriority, offset =
o_orderkey * 100, status from o_orderstatus (F completed, O pending,
P failed above 200 000 else running). Page attempts = lineitem rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.operators import bronze, ledger, records
from granary.plans import pages
from granary.plans.registry import query
from granary.plans.tables import load

LIMIT = 100
RUN = "1-URGENT"


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = load(spark, sf_dir, "orders")
    status = (F.when(F.col("o_orderstatus") == "F", "completed").when(F.col("o_orderstatus") == "O", "pending")
              .when(F.col("o_totalprice") > 200000, "failed").otherwise("running"))
    return o.select(
        F.col("o_orderpriority").alias("run_id"),
        (F.col("o_orderkey") * LIMIT).alias("offset_value"),
        status.alias("status"),
        F.when(status == "completed", (F.col("o_totalprice") / 10000).cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("records_fetched"),
        F.col("o_orderdate").alias("started_at"),
        F.when(status == "completed", F.col("o_orderdate") + F.expr("INTERVAL '1 00:00:00.25' DAY TO SECOND")).alias("completed_at"),
        F.when(status == "failed", F.concat(F.lit("HTTP 503 at offset "), (F.col("o_orderkey") * LIMIT).cast("string"))).alias("error_message"),
    )


JOBS_SQL = f"""WITH jobs AS (
  SELECT o_orderpriority AS run_id, o_orderkey * {LIMIT} AS offset_value, st AS status,
    CASE WHEN st = 'completed' THEN CAST(trunc(o_totalprice / 10000) AS BIGINT) ELSE 0 END AS records_fetched,
    o_orderdate AS started_at, CASE WHEN st = 'completed' THEN o_orderdate + INTERVAL 1 DAY + INTERVAL 250 MILLISECOND END AS completed_at,
    CASE WHEN st = 'failed' THEN 'HTTP 503 at offset ' || CAST(o_orderkey * {LIMIT} AS VARCHAR) END AS error_message
  FROM (SELECT *, CASE WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'O' THEN 'pending'
                       WHEN o_totalprice > 200000 THEN 'failed' ELSE 'running' END AS st FROM orders) o),
runs AS (
  SELECT run_id, min(started_at) AS started_at,
    CASE WHEN bool_and(status = 'completed') THEN max(completed_at) END AS completed_at, count(*) AS jobs,
    CASE WHEN bool_and(status = 'completed') THEN 'completed'
         WHEN bool_or(status IN ('pending', 'running')) THEN 'running' ELSE 'failed' END AS status
  FROM jobs GROUP BY run_id)
"""


@query(
    "job_status_counts",
    JOBS_SQL + """SELECT count(*) AS total, count(*) FILTER (WHERE status = 'completed') AS completed,
  count(*) FILTER (WHERE status = 'failed') AS failed, count(*) FILTER (WHERE status = 'pending') AS pending,
  count(*) FILTER (WHERE status = 'running') AS running_or_crashed FROM jobs""",
)
def job_status_counts(spark, sf_dir):
    return ledger.job_status_counts(jobs(spark, sf_dir))


@query("q_job_health", JOBS_SQL + "SELECT status, count(*) AS job_count FROM jobs GROUP BY status")
def q_job_health(spark, sf_dir):
    return ledger.job_health(jobs(spark, sf_dir))


@query(
    "incomplete_jobs",
    JOBS_SQL + f"SELECT * FROM jobs WHERE run_id = '{RUN}' AND status IN ('pending', 'running', 'failed') ORDER BY offset_value",
)
def incomplete_jobs(spark, sf_dir):
    return ledger.incomplete_jobs(jobs(spark, sf_dir), RUN)


@query("run_ledger", JOBS_SQL + "SELECT * FROM runs")
def run_ledger(spark, sf_dir):
    return ledger.run_ledger(jobs(spark, sf_dir))


@query(
    "latest_incomplete_run",
    JOBS_SQL + "SELECT run_id, started_at FROM runs WHERE status <> 'completed' ORDER BY started_at DESC, run_id DESC LIMIT 1",
)
def latest_incomplete_run(spark, sf_dir):
    return ledger.latest_incomplete_run(ledger.run_ledger(jobs(spark, sf_dir)), fresh_id="run-new")


@query(
    "resume_frontier",
    JOBS_SQL + f"""SELECT r.run_id, CAST(coalesce(max(j.offset_value) + {LIMIT}, 0) AS BIGINT) AS next_offset
FROM (SELECT run_id FROM runs UNION SELECT c_mktsegment FROM customer) r LEFT JOIN jobs j ON j.run_id = r.run_id GROUP BY 1""",
)
def resume_frontier(spark, sf_dir):
    """Runs of the ledger, and runs registered (one per market segment) that have no job yet."""
    j = jobs(spark, sf_dir)
    runs = j.select("run_id").union(load(spark, sf_dir, "customer").select("c_mktsegment"))
    return ledger.resume_frontier(j, LIMIT, runs)


def _total(spark, sf_dir) -> int:
    return load(spark, sf_dir, "orders").count() * LIMIT


@query("offset_plan", f"SELECT unnest(range(0, (SELECT count(*) FROM orders) * {LIMIT}, {LIMIT})) AS offset_value")
def offset_plan(spark, sf_dir):
    return ledger.offset_plan(spark, _total(spark, sf_dir), LIMIT)


@query(
    "resume_plan",
    JOBS_SQL + f"""SELECT offset_value FROM (SELECT unnest(range(0, (SELECT count(*) FROM orders) * {LIMIT}, {LIMIT})) AS offset_value) p
WHERE offset_value NOT IN (SELECT offset_value FROM jobs WHERE run_id = '{RUN}' AND status = 'completed')""",
)
def resume_plan(spark, sf_dir):
    planned = ledger.offset_plan(spark, _total(spark, sf_dir), LIMIT)
    return ledger.resume_plan(planned, jobs(spark, sf_dir), RUN)


_ATTEMPT_ORDER = ["l_shipdate", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                  "l_discount", "l_tax"]


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem")
    ok = F.col("l_linestatus") == "F"
    return li.select(
        F.col("l_returnflag").alias("run_id"), (F.col("l_orderkey") * LIMIT).alias("offset_value"),
        F.when(ok, "completed").otherwise("failed").alias("status"),
        F.when(ok, F.col("l_quantity").cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("records_fetched"),
        F.col("l_shipdate").alias("started_at"),
        F.when(ok, F.col("l_shipdate") + F.expr("INTERVAL 2 HOURS")).alias("completed_at"),
        F.when(~ok, F.concat(F.lit("timeout on line "), F.col("l_linenumber").cast("string"))).alias("error_message"),
        *_ATTEMPT_ORDER,
    )


@query(
    "job_ledger",
    f"""WITH a AS (
  SELECT l_returnflag AS run_id, l_orderkey * {LIMIT} AS offset_value,
    CASE WHEN l_linestatus = 'F' THEN 'completed' ELSE 'failed' END AS status,
    CASE WHEN l_linestatus = 'F' THEN CAST(l_quantity AS BIGINT) ELSE 0 END AS records_fetched,
    l_shipdate AS started_at, CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 2 HOUR END AS completed_at,
    CASE WHEN l_linestatus <> 'F' THEN 'timeout on line ' || CAST(l_linenumber AS VARCHAR) END AS error_message,
    row_number() OVER (PARTITION BY l_returnflag, l_orderkey ORDER BY {", ".join(c + " DESC" for c in _ATTEMPT_ORDER)}) AS rn,
    min(l_shipdate) OVER (PARTITION BY l_returnflag, l_orderkey) AS first_start,
    count(*) OVER (PARTITION BY l_returnflag, l_orderkey) AS attempts
  FROM lineitem)
SELECT run_id, offset_value, status, records_fetched, first_start AS started_at, completed_at, error_message, attempts
FROM a WHERE rn = 1""",
)
def job_ledger(spark, sf_dir):
    return ledger.job_ledger(attempts(spark, sf_dir), _ATTEMPT_ORDER)


@query(
    "q_throughput_history",
    JOBS_SQL + """SELECT run_id, records_inserted, duration_seconds, throughput_per_second FROM (
  SELECT run_id, CAST(sum(records_fetched) FILTER (WHERE status = 'completed') AS BIGINT) AS records_inserted,
    date_diff('microsecond', min(started_at), max(completed_at)) / 1e6 AS duration_seconds,
    round(sum(records_fetched) FILTER (WHERE status = 'completed') /
          (date_diff('microsecond', min(started_at), max(completed_at)) / 1e6), 2) AS throughput_per_second,
    max(completed_at) AS created_at
  FROM jobs GROUP BY run_id) m ORDER BY created_at DESC, run_id""",
)
def q_throughput_history(spark, sf_dir):
    j = jobs(spark, sf_dir)
    done = F.col("status") == "completed"
    m = j.groupBy("run_id").agg(
        F.sum(F.when(done, F.col("records_fetched"))).alias("records_inserted"),
        ledger.elapsed_seconds(F.min("started_at"), F.max("completed_at")).alias("duration_seconds"),
        F.max("completed_at").alias("created_at"),
    ).withColumn("throughput_per_second", F.round(F.col("records_inserted") / F.col("duration_seconds"), 2))
    return m.orderBy(F.desc("created_at"), "run_id").select(
        "run_id", "records_inserted", "duration_seconds", "throughput_per_second")


RUN_METRICS_SQL = f"""WITH pg AS (
  SELECT o_orderkey // 100 AS page_id, count(*) AS n, max(o_totalprice) AS mx FROM orders GROUP BY 1)
SELECT 'run-orders' AS run_id,
  CAST((SELECT sum(n) FROM pg) AS BIGINT) AS records_fetched,
  (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS records_inserted,
  (SELECT count(*) FROM orders WHERE o_orderstatus = 'F') AS records_updated,
  (SELECT count(*) FROM pg WHERE mx > {pages.ERROR_PRICE}) AS records_failed,
  round((SELECT max(page_id) - min(page_id) FROM pg) * CAST(0.0125 AS DOUBLE), 2) AS duration_seconds,
  round((SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') /
        ((SELECT max(page_id) - min(page_id) FROM pg) * CAST(0.0125 AS DOUBLE)), 2) AS throughput_per_second"""


@query("run_metrics", RUN_METRICS_SQL)
def run_metrics(spark, sf_dir):
    """Orders pages fetched 12.5 ms apart; finished orders (status F)
    were already in bronze from an earlier run, so they count as updates."""
    p = pages.orders_pages(spark, sf_dir).withColumn(
        "fetched_at", F.col("fetched_at") + F.make_dt_interval(secs=(F.col("offset") / pages.PAGE_SIZE * 0.0125).cast("decimal(18,6)")))
    p = records.parse_envelope(p).withColumn("is_error", records.is_error_page(F.col("raw_json"), F.col("env")))
    page_rows = p.select("run_id", F.coalesce(F.size("env.records"), F.lit(0)).cast("bigint").alias("n_records"),
                         "is_error", "fetched_at")
    good = p.where(~F.col("is_error"))
    recs = records.explode_records(good, keep=["run_id", "offset", "attempt", "fetched_at"])
    recs = bronze.enrich(recs, source_dataset=pages.DATASET_NAME, source_resource_id=pages.RESOURCE_ID,
                         source_system="api").withColumn("ingested_at", F.col("fetched_at"))
    earlier = recs.where(F.col("record").getItem("o_orderstatus") == "F")
    existing = bronze.bronze_upsert(None, earlier, seq=["offset", "attempt", "record_no"]).drop("was_present", "in_batch")
    merged = bronze.bronze_upsert(existing, recs, seq=["offset", "attempt", "record_no"])
    merge_rows = merged.select(F.lit("run-orders").alias("run_id"), "was_present", "in_batch")
    return ledger.run_metrics(page_rows, merge_rows)


LISTING_SQL = """SELECT page_id, url, strlen(html) AS local_size, true AS local_exists,
  CASE WHEN url LIKE 'https%' THEN strlen(html) ELSE 0 END AS remote_size FROM pages"""


@query(
    "manifest_skip",
    f"""WITH l AS ({LISTING_SQL}),
m AS (SELECT url AS murl, strlen(html) - CASE WHEN url LIKE '%#%' THEN 1 ELSE 0 END AS recorded_size
      FROM pages WHERE url LIKE '%.com%')
SELECT l.*, coalesce(m.murl IS NOT NULL AND l.local_exists AND
  ((l.remote_size > 0 AND l.local_size = l.remote_size) OR coalesce(m.recorded_size = l.local_size, false)), false) AS skip
FROM l LEFT JOIN m ON l.url = m.murl""",
)
def manifest_skip(spark, sf_dir):
    pg = load(spark, sf_dir, "pages")
    size = F.octet_length("html").cast("bigint")
    listing = pg.select("page_id", "url", size.alias("local_size"), F.lit(True).alias("local_exists"),
                        F.when(F.col("url").startswith("https"), size).otherwise(F.lit(0).cast("bigint")).alias("remote_size"))
    manifest = pg.where(F.col("url").contains(".com")).select(
        F.col("url").alias("source_url"),
        (size - F.when(F.col("url").contains("#"), 1).otherwise(0)).alias("file_size"))
    return ledger.manifest_skip(listing, manifest)


@query(
    "export_filter",
    "SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-05 00:00:00' AND event_type = 'click' AND CAST(user_id AS VARCHAR) = '8'",
)
def export_filter(spark, sf_dir):
    from granary.operators.exports import export_filter as f
    ev = load(spark, sf_dir, "events")
    return f(ev, since="2024-01-05 00:00:00", where={"event_type": "click", "user_id": 8}, ts_col="ts")


@query(
    "preview_rows",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM orders ORDER BY o_orderkey LIMIT 5",
)
def preview_rows(spark, sf_dir):
    from granary.operators.exports import preview
    return preview(load(spark, sf_dir, "orders"), n=5, n_cols=5, order_by=["o_orderkey"])


@query(
    "resume_anti_join",
    f"""WITH planned AS (SELECT DISTINCT l_returnflag AS run_id, o_orderkey * {LIMIT} AS offset_value
  FROM orders, (SELECT DISTINCT l_returnflag FROM lineitem) r)
SELECT run_id, offset_value FROM planned p WHERE NOT EXISTS (SELECT 1 FROM lineitem l
  WHERE l.l_linestatus = 'F' AND l.l_returnflag = p.run_id AND l.l_orderkey * {LIMIT} = p.offset_value)""",
)
def resume_anti_join(spark, sf_dir):
    """Planned jobs (every offset in each run) that no attempt of the same run has completed."""
    runs = load(spark, sf_dir, "lineitem").select(F.collect_set("l_returnflag").alias("runs"))
    names = sorted(runs.first()["runs"])  # the runs' ids: a handful
    planned = load(spark, sf_dir, "orders").select(
        F.explode(F.array(*[F.lit(n) for n in names])).alias("run_id"), (F.col("o_orderkey") * LIMIT).alias("offset_value"))
    return ledger.unfinished(planned, attempts(spark, sf_dir))
