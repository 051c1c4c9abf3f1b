"""Structured Streaming forms of ingest, deduplication and quality checks.

New files in a landing folder are processed once (the checkpoint records
which files were seen); each micro-batch is written by ``foreachBatch`` into
its own ``batch=<id>`` folder with overwrite, so a replayed batch after a
failure rewrites the same folder instead of appending twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import quality
from granary.operators.bronze import bronze_upsert
from granary.operators.ingest import bronze_table, land
from granary.operators.records import failed_jobs

FOLD_EVERY = 10  # micro-batches that stay deltas until they are folded into the table
#: keys seen are kept on the executors' disks and saved by what changed, not held on the heap
KEYED_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None, options: dict[str, str] | None = None) -> DataFrame:
    """Streaming read of a landing folder with an explicit schema."""
    r = spark.readStream.format(fmt).schema(schema).options(**(options or {}))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def _has_data(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and any(st.getPath().getName().startswith("batch=") for st in fs.listStatus(p))


def _start(writer, settings: dict[str, str], spark: SparkSession):
    """Start a query under settings of its own: it copies the session's as it starts."""
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        return writer.start()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def for_each_batch(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, available_now: bool = True,
                   settings: dict[str, str] | None = None):
    """With ``available_now`` the call returns when the available input is done;
    otherwise it returns the running query at once."""
    w = df.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    q = _start(w.trigger(availableNow=True) if available_now else w, settings or {}, df.sparkSession)
    if available_now:
        q.awaitTermination()
    return q


def write_batches(df: DataFrame, target: str, checkpoint: str,
                  transform: Callable[[DataFrame, int], DataFrame] | None = None,
                  available_now: bool = True, settings: dict[str, str] | None = None):
    """Every micro-batch goes (after ``transform``) to ``target/batch=<id>``."""

    def each(batch: DataFrame, batch_id: int) -> None:
        out = transform(batch, batch_id) if transform else batch
        out.write.mode("overwrite").parquet(f"{target}/batch={batch_id}")

    return for_each_batch(df, each, checkpoint, available_now, settings)


def read_batches(spark: SparkSession, target: str, schema: T.StructType | None = None) -> DataFrame:
    """All batches written so far (``batch`` column dropped)."""
    if not _has_data(spark, target):
        if schema is None:
            raise FileNotFoundError(target)
        return spark.createDataFrame([], schema)
    return spark.read.parquet(target).drop("batch")


def _merge(base: DataFrame | None, deltas: DataFrame) -> DataFrame:
    """Rows of a table with later batches: the first batch's lineage, the last one's record, the latest time."""
    return bronze_upsert(base, deltas, seq=["_batch"])


def stream_ingest(pages: DataFrame, target: str, checkpoint: str, *, dataset: str, resource: str, system: str,
                  available_now: bool = True, fold_every: int = FOLD_EVERY):
    """Landed page files into bronze: insert, or refresh on repeat, by record hash.

    A micro-batch's pages are routed, parsed and written once, its records
    reduced to one row per hash and committed as a delta of the table in
    ``target``; quarantined pages go to ``<target>-rejects/batch=<id>``. Every
    ``fold_every`` batches the deltas are folded into the table's slots, and
    what no snapshot needs any more is dropped. So a batch costs what its own
    rows cost, and :func:`read_merged` opens the table's files and a few
    deltas. A batch that is run again replaces its delta, or changes nothing if
    it is folded in already; what was written before a crash but not
    committed is never read.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        landed = land(batch, dataset=dataset, resource=resource, system=system)
        failed_jobs(landed.rejects).write.mode("overwrite").parquet(f"{target}-rejects/batch={batch_id}")
        merged = bronze_upsert(None, landed.records, seq=["fetched_at", "offset", "attempt", "record_no"])
        table = bronze_table(spark, target)
        now = table.add_delta(merged.drop("was_present", "in_batch"), batch_id)
        if len(now.deltas) >= fold_every:
            table.fold(_merge)
            table.vacuum(keep=2)

    return for_each_batch(pages, each, checkpoint, available_now)


def read_merged(spark: SparkSession, target: str) -> DataFrame:
    """Bronze as of the newest commit: per hash the first batch's lineage, the last batch's record and the
    latest ``ingested_at``. The table's side of the join is bucketed and isn't moved."""
    table = bronze_table(spark, target)
    now = table.snapshot()
    base = table.read(at=now) if now.slots else None
    deltas = table.deltas(now)
    if deltas is None:
        return table.read(at=now)
    return _merge(base, deltas).drop("was_present", "in_batch")


def stream_dedup(stream: DataFrame, target: str, checkpoint: str, key: str, available_now: bool = True):
    """Each ``key`` once, however late and however far apart its repeats.

    The keys seen are Spark's keyed state (no watermark, so none is ever
    forgotten), kept by RocksDB on the executors' disks and saved to the
    checkpoint by what a batch changed. A batch looks up its own keys only, so
    its time doesn't grow with what came before; state and batch number go
    together, so a batch that is run again gives the same rows.
    """
    return write_batches(stream.dropDuplicates([key]), target, checkpoint, available_now=available_now, settings=KEYED_STATE)


def stream_dq(stream: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """The batch quality rules on a stream (stateless, per row)."""
    return quality.issues(stream, rules)
