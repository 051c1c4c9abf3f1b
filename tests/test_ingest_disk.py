"""Ingest keeps little on the disk: portions of pages, merges by rounds, shuffles that go."""

import datetime
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import bronze, ingest
from granary.plans import crop, q_ingest
from granary.session import release, scratch_path, shared_dir
from granary.sinks import keyed_table

LANDED = "run_id string, offset long, attempt int, fetched_at timestamp_ntz, raw_json string"


def page(run, i, text):
    return (run, i, 1, datetime.datetime(2024, 1, 1, 0, 0, i), text)


def scratch(spark, name):
    return {n for n in keyed_table.folders(spark, shared_dir(spark).rstrip("/") + "/granary") if n.startswith(f"{name}-")}


def keyed(spark, keys, day):
    return spark.createDataFrame([(str(k),) for k in keys], "k string").select(
        F.sha2("k", 256).alias("source_record_hash"), F.lit(f"d{day}").alias("source_dataset"), F.lit("r").alias("source_resource_id"),
        F.lit("s").alias("source_system"), F.lit(f"2024-01-{day:02d}").cast("timestamp_ntz").alias("ingested_at"),
        F.create_map(F.lit("k"), F.col("k")).alias("record"), F.lit(day).alias("seq"))


def test_a_merge_goes_by_rounds_and_drops_their_pieces(spark, monkeypatch):
    monkeypatch.setattr(keyed_table, "PIECES", 8)
    table = ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=4, buckets=2)
    bronze.merge_into(table, keyed(spark, [*range(40), *range(10)], 1), seq=["seq"])
    whole = bronze.bronze_upsert(table.read().localCheckpoint(), keyed(spark, [*range(20, 60), *range(25)], 2), seq=["seq"]).drop("was_present", "in_batch").collect()
    monkeypatch.setattr(keyed_table, "ROUND_BYTES", 1)
    staged = keyed_table.stage(keyed(spark, [*range(20, 60), *range(25)], 2), table.piece_of(), scratch_path(spark, "merge"))
    taken, left, join = [], [], bronze._join

    def watched(base, rows, record_col):
        taken.append({r[0] for r in rows.select(table.piece_of()).distinct().collect()})
        left.append(set(staged.sizes()))
        return join(base, rows, record_col)

    monkeypatch.setattr(bronze, "_join", watched)
    drafts, number = scratch(spark, "merge"), table.snapshot().number
    assert bronze.merge_into(table, staged, seq=["seq"]) == {"new": 20, "old": 40}
    assert all(len(t) <= 1 for t in taken) and sum(map(len, taken)) == 8
    assert all(t <= now for t, now in zip(taken, left)) and [len(x) for x in left] == sorted((len(x) for x in left), reverse=True)
    assert not staged.sizes() and scratch(spark, "merge") == drafts and table.snapshot().number == number + 1
    assert sorted(map(tuple, table.read().collect()), key=lambda r: r[0]) == sorted(map(tuple, whole), key=lambda r: r[0])


def test_a_piece_without_rows_keeps_its_part_of_the_slot(spark, monkeypatch):
    monkeypatch.setattr(keyed_table, "ROUND_BYTES", 1)
    monkeypatch.setattr(keyed_table, "PIECES", 4)
    table = keyed_table.KeyedTable(spark, scratch_path(spark, "kt"), T.StructType([T.StructField("k", T.StringType()), T.StructField("v", T.LongType())]), "k", slots=2, buckets=2)
    both = lambda base, rows: rows if base is None else base.join(rows.withColumnRenamed("v", "w"), "k", "full").select("k", F.coalesce("w", "v").alias("v"))
    table.merge(spark.createDataFrame([(str(i), i) for i in range(30)] + [(None, 7)], "k string, v long"), both)
    table.merge(spark.createDataFrame([("3", 33)], "k string, v long"), both)
    assert sorted(table.read().collect(), key=str) == sorted([T.Row(k=str(i), v=33 if i == 3 else i) for i in range(30)] + [T.Row(k=None, v=7)], key=str)


def test_release_lets_go_of_the_last_query_too(spark):
    disk = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager()

    def shuffles():
        files = disk.getAllFiles()
        return {name for name in (files.apply(i).getName() for i in range(files.size())) if name.startswith("shuffle_")}

    release(spark)
    time.sleep(1)
    before = shuffles()
    spark.range(1000).repartition(4, "id").write.parquet(scratch_path(spark, "released"))
    assert shuffles() - before
    release(spark)
    until = time.time() + 10
    while shuffles() - before and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - before


def test_portions_land_as_the_whole_does(spark):
    texts = ['{"status":"ok","records":[{"a":"1"},{"a":"2","b":null}]}', '{"status":"error","error":"late"}', "{cut", '{"status":"ok","records":[]}',
             '{"status":"ok","records":[{"a":"1"}]}', '{"status":"ok","records":[{"c":"3"}]}', '{"status":"ok","records":"x"}', None]
    rows = [page("run", i, t) for i, t in enumerate(texts)]
    parts = [spark.createDataFrame(rows[lo:lo + 3], LANDED) for lo in range(0, len(rows), 3)] + [spark.createDataFrame([], LANDED)]
    names = {"dataset": "d", "resource": "r", "system": "s"}
    catalogue = spark.createDataFrame([("r", "a", "keyword", datetime.datetime(2023, 1, 1))], "dataset_id string, field_name string, field_type string, discovered_at timestamp_ntz")
    got = []
    for pages in (spark.createDataFrame(rows, LANDED), parts):
        done = ingest.ingest(pages, ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=4, buckets=2), catalogue, **names)
        got.append([sorted(map(str, x.collect())) for x in (done.table, done.catalogue, done.rejects, done.metrics)])
    assert got[0] == got[1]
    assert [len(x) for x in got[0]] == [3, 3, 4, 1] and "records_fetched=4, records_inserted=3, records_updated=0, records_failed=4" in got[0][3][0]
    one, all_ = (ingest.land(p, **names) for p in (parts, parts[0]))
    assert one.seen["pages"] == 8 and one.records.count() == 4 and one.rejects.count() == 4 and all_.seen["failed"] == 2


def test_several_runs_are_still_counted_from_the_records(spark):
    rows = [page(f"run-{i % 2}", i, '{"status":"ok","records":[{"a":"%d"}]}' % (i // 2)) for i in range(6)]
    catalogue = spark.createDataFrame([], "dataset_id string, field_name string, field_type string, discovered_at timestamp_ntz")
    table = ingest.bronze_table(spark, scratch_path(spark, "kt"), slots=2, buckets=2)
    done = ingest.ingest([spark.createDataFrame(rows[:4], LANDED), spark.createDataFrame(rows[4:], LANDED)], table, catalogue, dataset="d", resource="r", system="s")
    assert sorted((r["run_id"], r["records_fetched"], r["records_inserted"]) for r in done.metrics.collect()) == [("run-0", 3, 3), ("run-1", 3, 3)]
    assert [r["field_name"] for r in done.catalogue.collect()] == ["a"] and done.table.count() == 3


def tables(spark, path, orders):
    day = datetime.datetime(1995, 3, 1)
    lines = [(o, p, 1, n, 5.0, 100.0 + n if o != 7 else 104200.0, 0.0, 0.0, "A", "F" if n == 1 else "O", day) for o in orders for p, n in ((1, 1), (2, 2), (2, 5))]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    for name, rows, ddl in (("lineitem", lines, schema), ("part", [(1, "A"), (2, "B"), (2, "B")], "p_partkey long, p_brand string"),
                            ("supplier", [(1, 1)], "s_suppkey long, s_nationkey int"), ("nation", [(1, "N", 1)], "n_nationkey int, n_name string, n_regionkey int"), ("region", [(1, "R")], "r_regionkey int, r_name string")):
        spark.createDataFrame(rows, ddl).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def test_pages_in_portions_are_the_pages(spark, tmp_path, monkeypatch):
    sf_dir = tables(spark, tmp_path, [None, -25, 0, 7, 19, 20, 45, 61, 83, 104, 140, 141])
    kinds = {}
    for lines in (10**6, 9):
        monkeypatch.setattr(crop, "PORTION_LINES", lines)
        portions = crop.crop_portions(spark, sf_dir, faults=True)
        rows = [r for p in portions for r in p.select("offset", "attempt", F.from_json("raw_json", "records array<map<string,string>>")["records"].alias("r"), "fetched_at").collect()]
        kinds[len(portions)] = sorted((str(r["offset"]), r["attempt"], sorted(map(str, r["r"] or [])), str(r["fetched_at"])) for r in rows)
        table = [sorted(map(str, getattr(q_ingest, f"ingest_{name}")(spark, sf_dir).collect())) for name in ("batch", "rejects", "catalogue", "metrics")]
        kinds.setdefault("ingested", table)
        assert kinds["ingested"] == table
    assert sorted(k for k in kinds if k != "ingested") == [1, 4] and kinds[1] == kinds[4] and len(kinds[1]) > 8
    assert crop.crop_pages(spark, sf_dir, faults=True)._jdf.queryExecution().executedPlan().toString().count("hashpartitioning") <= 3
