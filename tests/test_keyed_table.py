"""Merges in place: touched slots only, commits, deltas; streams on top of it."""

import statistics
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import bronze, ingest
from granary.session import scratch_path
from granary.sinks import writers
from granary.sinks.keyed_table import Snapshot
from granary.streaming import ingest as streams


def rows(spark, lo, hi, dataset="a", seq=0, day=1):
    return spark.range(lo, hi).select(
        F.sha2(F.col("id").cast("string"), 256).alias("source_record_hash"), F.lit(dataset).alias("source_dataset"),
        F.lit("r").alias("source_resource_id"), F.lit("s").alias("source_system"),
        F.lit(f"2024-01-{day:02d}").cast("timestamp_ntz").alias("ingested_at"),
        F.create_map(F.lit("k"), F.concat(F.lit(f"{dataset}"), F.col("id").cast("string"))).alias("record"), F.lit(seq).alias("seq"))


def files_of(table):
    return {str(p) for p in Path(table.path.removeprefix("file:")).rglob("*.parquet")}


def test_a_merge_rewrites_touched_slots_and_moves_no_base_row(spark, monkeypatch):
    table = ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=16, buckets=4)
    assert bronze.merge_into(table, rows(spark, 0, 2000), seq=["seq"]) == {"new": 2000, "old": 0}
    first, old = table.snapshot(), files_of(table)
    plans = []
    join = bronze._join

    def planned(*args):
        out = join(*args)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(bronze, "_join", planned)
    batch = rows(spark, 1998, 2001, "b", 1, 2)
    assert bronze.merge_into(table, batch, seq=["seq"]) == {"new": 1, "old": 2}
    touched = {s for s, v in table.snapshot().slots.items() if first.slots.get(s) != v}
    assert 1 <= len(touched) <= 3
    new = files_of(table) - old
    assert len(new) <= 4 * len(touched) and all(any(f"_slot={t}/" in f for t in touched) for f in new)
    assert "Bucketed: true" in plans[0] and plans[0].count("Exchange") == plans[0].count("REPARTITION_BY_NUM") == 1
    whole = bronze.bronze_upsert(rows(spark, 0, 2000).drop("seq"), batch, seq=["seq"]).drop("was_present", "in_batch")
    assert sorted(table.read().collect(), key=lambda r: r[0]) == sorted(whole.collect(), key=lambda r: r[0])
    assert table.read(at=first).count() == 2000
    assert table.vacuum() == len(touched) and table.read().count() == 2001


def test_other_session_and_refused_settings(spark):
    table = ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=4, buckets=2)
    bronze.merge_into(table, rows(spark, 0, 50), seq=["seq"])
    assert ingest.bronze_table(spark.newSession(), table.path, 4, 2).read().count() == 50
    with pytest.raises(ValueError):
        ingest.bronze_table(spark.newSession(), table.path, 8, 2).read()
    bronze.merge_into(table, rows(spark, 0, 0), seq=["seq"])
    assert table.read().count() == 50


def test_a_crash_before_the_commit_changes_nothing(spark, monkeypatch):
    table = ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=4, buckets=2)
    bronze.merge_into(table, rows(spark, 0, 50), seq=["seq"])
    before = table.read().collect()
    with monkeypatch.context() as m:
        m.setattr(type(table), "_commit", lambda self, new: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            bronze.merge_into(table, rows(spark, 40, 90, "b", 1, 2), seq=["seq"])
        with pytest.raises(OSError):
            table.add_delta(rows(spark, 40, 90).drop("seq"), 3)
    assert sorted(table.read().collect()) == sorted(before) and table.deltas() is None
    assert bronze.merge_into(table, rows(spark, 40, 90, "b", 1, 2), seq=["seq"]) == {"new": 40, "old": 10}
    assert table.read().count() == 90 and table.vacuum() > 0 and table.read().count() == 90


def test_the_second_of_two_writers_fails(spark):
    table = ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=2, buckets=1)
    table._commit(Snapshot(1))
    with pytest.raises(RuntimeError):
        table._commit(Snapshot(1))


def test_deltas_and_folds(spark):
    table = ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=4, buckets=2)
    for batch in (0, 1, 1, 2):
        table.add_delta(rows(spark, batch * 10, batch * 10 + 15, f"d{batch}", day=batch + 1).drop("seq"), batch)
    assert len(table.snapshot().deltas) == 3
    table.fold(streams._merge)
    now = table.snapshot()
    assert (now.mark, now.deltas) == (2, {})
    table.add_delta(rows(spark, 0, 99).drop("seq"), 2)  # held already
    got = {r["record"]["k"][2:]: (r["source_dataset"], r["record"]["k"][:2]) for r in table.read().collect()}
    assert len(got) == 35 and got["12"] == ("d0", "d1") and got["3"] == ("d0", "d0") and got["34"] == ("d2", "d2")


def test_stream_ingest_reads_a_bounded_number_of_files(spark):
    from granary.sources.files import LANDED_PAGE

    land, target, ckpt = (scratch_path(spark, n) for n in ("many-pages", "many-bronze", "many-ckpt"))
    names = [f.name for f in LANDED_PAGE.fields]
    schema = ", ".join(f"{f.name} {'string' if f.name == 'fetched_at' else f.dataType.simpleString()}" for f in LANDED_PAGE.fields)
    page = lambda i: ("api", "res", "run", i, 10, "u", {}, '{"status":"ok","records":[{"k":"%d"}]}' % (i % 9), f"2024-01-01T00:00:{i:02d}.000000", 1)
    for i in range(24):
        spark.createDataFrame([page(i)], schema).select(*names).coalesce(1).write.mode("append").json(land)
    stream = streams.file_stream(spark, land, LANDED_PAGE, "json", 1, {"timestampNTZFormat": writers.TS_NTZ_FORMAT})
    streams.stream_ingest(stream, target, ckpt, dataset="d", resource="res", system="api", fold_every=5)
    table = ingest.bronze_table(spark, target)
    now = table.snapshot()
    assert now.mark is not None and len(now.deltas) < 5
    got = {r["record"]["k"]: str(r["ingested_at"]) for r in streams.read_merged(spark, target).collect()}
    last = {str(i % 9): f"2024-01-01 00:00:{i:02d}" for i in range(24)}
    assert got == last
    assert spark.sparkContext._jsc.sc().getPersistentRDDs().size() == 0


def test_stream_dedup_time_is_flat(spark):
    land, target, ckpt = (scratch_path(spark, n) for n in ("dup-land", "dup-out", "dup-ckpt"))
    spark.range(0, 30 * 200, 1, 30).select((F.col("id") % 4000).alias("k")).write.parquet(land)
    stream = streams.file_stream(spark, land, spark.range(1).select(F.col("id").alias("k")).schema, max_files_per_trigger=1)
    q = streams.stream_dedup(stream, target, ckpt, "k")
    took = [p["durationMs"]["triggerExecution"] for p in q.recentProgress if p["numInputRows"]]
    assert len(took) == 30 and statistics.median(took[-10:]) < 2 * statistics.median(took[5:15])
    got = streams.read_batches(spark, target)
    assert got.count() == got.distinct().count() == 4000
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_evolved_files_read_as_one_table(spark):
    path = scratch_path(spark, "evolved")
    for rows, ddl in (([("1", "x")], "a string, b string"), ([("2", "y", "z")], "a string, b string, c string"), ([("3", "w")], "a string, d string")):
        bronze.append_evolved(spark.createDataFrame(rows, ddl), path)
    got = {r["a"]: (r["b"], r["c"], r["d"]) for r in bronze.read_evolved(spark, path).collect()}
    assert got == {"1": ("x", None, None), "2": ("y", "z", None), "3": (None, None, "w")}


def test_merge_leaves_no_draft(spark, tmp_path):
    from granary.session import shared_dir
    from granary.sinks import keyed_table

    def drafts():
        return {n for n in keyed_table.folders(spark, shared_dir(spark).rstrip("/") + "/granary") if n.startswith("merge-")}

    schema = T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())])
    table = keyed_table.KeyedTable(spark, str(tmp_path / "t"), schema, "k", slots=2, buckets=2)
    before = drafts()
    table.merge(spark.createDataFrame([("a", 1), ("b", 2)], "k string, v long"), lambda base, rows: rows)
    assert drafts() == before
    assert sorted(map(tuple, table.read().collect())) == [("a", 1), ("b", 2)]
