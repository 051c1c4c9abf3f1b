"""Operator properties against brute force on small inputs, including a hot
key holding a third of the rows."""

import itertools
import random

import pytest

from pyspark.sql import Window
from pyspark.sql import functions as F

from granary.operators import bronze, graph, lineage, reshape
from granary.operators.sequence import successor_pairs
from granary.session import scratch_path
from granary.sinks import writers
from granary.streaming import ingest


def test_successor_pairs_hot_key_matches_window(spark):
    rnd = random.Random(7)
    rows = []
    for i in range(3000):
        user = 0 if i % 3 == 0 else rnd.randint(1, 50)  # user 0 holds a third of the rows
        rows.append((user, rnd.randint(0, 10_000), i, rnd.choice("abcde")))
    df = spark.createDataFrame(rows, "user_id long, ts long, event_id long, kind string")
    got = successor_pairs(df, "user_id", ["ts", "event_id"], ["kind"], num_partitions=16)
    got = sorted((r["user_id"], r["prev"]["event_id"], r["next"]["event_id"]) for r in got.collect())
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = (df.select("user_id", "event_id", F.lead("event_id").over(w).alias("nxt"))
            .where(F.col("nxt").isNotNull()).collect())
    assert got == sorted((r["user_id"], r["event_id"], r["nxt"]) for r in want)


def _brute_cycles(edges):
    nodes = sorted({x for e in edges for x in e})
    es = set(edges)
    out = set()
    for k in range(1, len(nodes) + 1):
        for combo in itertools.permutations(nodes, k):
            if combo[0] != min(combo):
                continue
            if all((combo[i], combo[(i + 1) % k]) in es for i in range(k)):
                out.add(combo)
    return out


def test_simple_cycles_matches_brute_force(spark):
    rnd = random.Random(3)
    nodes = list("abcdef")
    edges = sorted({(rnd.choice(nodes), rnd.choice(nodes)) for _ in range(14)} | {("x", "a")})
    df = spark.createDataFrame([(s, t, "T", "2000", "S", "src") for s, t in edges],
                               "source_district string, target_district string, event_type string, "
                               "effective_year string, state string, source string")
    got = {tuple(r["cycle"]) for r in graph.simple_cycles(df).collect()}
    assert got == _brute_cycles(edges)


def test_cyclic_core_empty_for_dag(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("a", "c")], "source_district string, target_district string")
    assert graph.cyclic_core(df).count() == 0


def test_bronze_upsert_first_writer_and_flags(spark):
    schema = "source_record_hash string, source_dataset string, source_resource_id string, source_system string, " \
             "ingested_at timestamp_ntz, record map<string,string>, seq int"
    old = spark.createDataFrame([], schema)
    rows = [("h1", "d1", "r", "s", None, {"k": "1"}, 1), ("h1", "d2", "r", "s", None, {"k": "1"}, 2),
            ("h2", "d2", "r", "s", None, {"k": "2"}, 3)]
    b1 = spark.createDataFrame(rows, schema).withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp_ntz"))
    first = bronze.bronze_upsert(None, b1, seq=["seq"]).drop("was_present", "in_batch")
    assert {(r["source_record_hash"], r["source_dataset"]) for r in first.collect()} == {("h1", "d1"), ("h2", "d2")}
    b2 = spark.createDataFrame([("h2", "d9", "r", "s", None, {"k": "2"}, 9), ("h3", "d9", "r", "s", None, {"k": "3"}, 9)],
                               schema).withColumn("ingested_at", F.lit("2024-03-01").cast("timestamp_ntz"))
    merged = {r["source_record_hash"]: r for r in bronze.bronze_upsert(first, b2, seq=["seq"]).collect()}
    assert merged["h2"]["source_dataset"] == "d2" and merged["h2"]["was_present"] and merged["h2"]["in_batch"]
    assert str(merged["h2"]["ingested_at"]).startswith("2024-03-01")
    assert not merged["h3"]["was_present"] and merged["h1"]["was_present"] and not merged["h1"]["in_batch"]
    assert old.count() == 0


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


@pytest.mark.parametrize("dist", [1, 2, 3])
def test_reference_validate_matches_brute_force(spark, dist):
    rnd = random.Random(11)
    alphabet = "abc"
    ref = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 5))) for _ in range(40)})
    targets = sorted({"".join(rnd.choice(alphabet) for _ in range(rnd.randint(2, 5))) for _ in range(40)})
    edges = spark.createDataFrame([("p", t, "SPLIT", "2000", "S", "f") for t in targets],
                                  "source_district string, target_district string, event_type string, "
                                  "effective_year string, state string, source string")
    directory = spark.createDataFrame([(n,) for n in ref], "name string")
    got = {r["district"]: (r["lgd_match"], r["confidence_score"]) for r in
           lineage.reference_validate(edges, directory, max_distance=dist).collect()}
    for t in targets:
        best = min(((_lev(t, n), n) for n in ref), default=(99, None))
        if best[0] <= dist:
            want = (True, 1.0 - best[0] / max(len(t), len(best[1])))
        else:
            want = (False, 0.0)
        assert got[t] == want, t
    none = {r["validation_notes"] for r in lineage.reference_validate(edges, None).collect()}
    assert none == {lineage.NO_DIRECTORY_NOTE}


@pytest.mark.parametrize("dist,hot", [(1, 256), (2, 256), (3, 256), (3, 2), (4, 256), (2, 0)])
def test_segment_candidates_match_brute_force(spark, dist, hot):
    """Every pair within the distance is found by segments, whichever of them count as hot."""
    rnd = random.Random(dist * 1000 + hot)
    ref = {"", "a", "shared prefix 1", "shared prefix 2", "shared prefix 33"}
    ref |= {"".join(rnd.choice("ab") for _ in range(rnd.randint(0, 9))) for _ in range(60)}
    names = {"", "bb", "shared prefix 34", "sharedprefix 2", "hared prefix 14"}
    for n in sorted(ref):
        t = list(n)
        for _ in range(rnd.randint(0, dist)):
            at = rnd.randint(0, len(t))
            t[at:at + rnd.randint(0, 1)] = rnd.choice(["", "a", "b", "é"])
        names.add("".join(t))
    names = sorted(names)
    left = spark.createDataFrame([(n,) for n in names], "district string")
    right = spark.createDataFrame([(n,) for n in sorted(ref)], "ref_name string")
    rows = [tuple(r) for r in lineage.candidates(left, right, dist, segments_from=1, hot=hot).collect()]
    assert len(rows) == len(set(rows))
    assert {(a, b) for a in names for b in ref if _lev(a, b) <= dist} <= set(rows)


def test_few_segment_keys_a_name(spark):
    name = spark.createDataFrame([("a district name of common length",)], "n string")
    probe, own, deleted = name.select(F.size(lineage._probe_keys(F.col("n"), 3)), F.size(lineage._segment_keys(F.col("n"), 3)),
                                      F.size(lineage._deletion_keys(F.col("n"), 3))).first()
    assert own == 4 and probe <= 44 and deleted > 4000


def test_tidy_narrow_equals_pivot(spark):
    rows = [(1, "S", "D", "2000", 1.0, None, 3.0, 4.0, None, 9.0),
            (2, "S", "E", "2001", None, None, None, None, None, None),
            (3, None, "F", "2002", 5.0, 6.0, None, None, 7.0, 1.0)]
    df = spark.createDataFrame(rows, "id int, State string, District string, Year string, "
                                     "Rice_Area_Hectare_Kharif double, Rice_Production_Tonnes_Kharif double, "
                                     "Rice_Production_Tonnes double, Rice_Production_Tonnes_Whole_Year double, "
                                     "Wheat_Yield_Tonne_Hectare_Rabi double, Total_Area double")
    ids = ["id", "State", "District", "Year"]
    narrow = reshape.wide_to_tidy(spark, df, ids, label=False)
    names = reshape.value_columns(df, ids)
    lm = reshape.melt_meta_join(reshape.wide_to_long(df, ids), reshape.column_meta(spark, names))
    metrics = reshape.metric_names(reshape.column_meta(spark, names))
    assert metrics == ["Area_Hectare", "Production_Tonnes", "Yield_Tonne_Hectare"]
    piv = reshape.pivot_metrics(lm, ids, metrics)
    cols = ids + ["Crop", "Season"] + metrics
    a = sorted(tuple(r) for r in narrow.select(*cols).collect())
    b = sorted(tuple(r) for r in piv.select(*cols).collect())
    assert a == b
    assert ("Rice", "Whole_Year") in {(r[4], r[5]) for r in a}
    # first non-null in column order: the season-less column comes first here
    rw = [r for r in a if r[0] == 1 and r[5] == "Whole_Year"][0]
    assert rw[cols.index("Production_Tonnes")] == 3.0
    assert all(r[1] is not None for r in a)  # NULL key rows dropped


def test_arrow_roundtrip(spark):
    df = spark.range(0, 1000).select(F.col("id"), (F.col("id") * 0.5).alias("x"),
                                     F.concat(F.lit("é-"), F.col("id").cast("string")).alias("s"))
    path = writers.write_arrow(df.repartition(3), scratch_path(spark, "test-arrow"))
    back = writers.read_arrow(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_stream_dedup_keeps_every_key_whatever_the_batches(spark):
    """Events far apart in time, repeated in later files, one file per micro-batch; a rerun adds nothing."""
    df = spark.range(0, 500).select((F.col("id") % 200).alias("k"), F.expr("timestamp'2024-01-01' + make_dt_interval(id * 40)").alias("ts"))
    land = scratch_path(spark, "test-land")
    df.orderBy("ts").coalesce(1).repartition(5).write.parquet(land)
    target, ckpt = scratch_path(spark, "test-target"), scratch_path(spark, "test-ckpt")
    for _ in range(2):
        ingest.stream_dedup(ingest.file_stream(spark, land, df.schema, max_files_per_trigger=1), target, ckpt, "k")
        got = ingest.read_batches(spark, target)
        assert got.count() == got.select("k").distinct().count() == 200


def test_stream_ingest_refreshes_and_sets_rejects_aside(spark):
    from granary.sources.files import LANDED_PAGE

    def page(offset, text, day):
        return ("api", "res", "run", offset, 10, "u", {}, text, f"2024-01-0{day}T00:00:00.000000", 1)

    ok = '{"status":"ok","records":[{"k":"%s"}]}'
    rows = [[page(0, ok % "a", 1)], [page(10, ok % "b", 1)], [page(20, '{"status":"ok","rec', 1)], [page(0, ok % "a", 2)]]
    land, target, ckpt = (scratch_path(spark, n) for n in ("test-pages", "test-bronze", "test-pages-ckpt"))
    names = [f.name for f in LANDED_PAGE.fields]
    schema = ", ".join(f"{f.name} {'string' if f.name == 'fetched_at' else f.dataType.simpleString()}" for f in LANDED_PAGE.fields)

    def run(batch):
        spark.createDataFrame(batch, schema).select(*names).coalesce(1).write.mode("append").json(land)
        stream = ingest.file_stream(spark, land, LANDED_PAGE, "json", 1, {"timestampNTZFormat": writers.TS_NTZ_FORMAT})
        ingest.stream_ingest(stream, target, ckpt, dataset="d", resource="res", system="api")

    for batch in rows:
        run(batch)
    got = {r["record"]["k"]: str(r["ingested_at"])[:10] for r in ingest.read_merged(spark, target).collect()}
    assert got == {"a": "2024-01-02", "b": "2024-01-01"}
    rejects = [(r["offset_value"], r["reason"], r["status"]) for r in spark.read.parquet(f"{target}-rejects").collect()]
    assert rejects == [(20, "malformed", "failed")]


def test_running_stream_is_returned(spark):
    land = scratch_path(spark, "test-live")
    spark.range(3).write.parquet(land)
    q = ingest.write_batches(ingest.file_stream(spark, land, spark.range(1).schema), scratch_path(spark, "live-out"),
                             scratch_path(spark, "live-ckpt"), available_now=False)
    try:
        assert q.isActive
    finally:
        q.stop()


def test_event_csv_skips_bad_entries(spark, tmp_path):
    from granary.sources.files import event_csv_rejects, read_event_csvs
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("State/UT,District-Before,District-After,Year\nS,old one,new one,2001\n")
    (raw / "b.csv").write_text("State/UT,Old Name,New Name,Decade\nS,x,y,1991-2001\n")
    (raw / "c.csv").write_text("Some,Other\n1,2\n")
    (raw / "d.pdf").write_text("%PDF")
    # the layout of a.csv in another order and with a further column
    (raw / "e.csv").write_text('Sl No,Year,District-After,District-Before,State/UT\n7,2002,"child, two",parent two,T\n')
    # values with line breaks, in a file that is read in several splits; an open quote
    (raw / "f.csv").write_text('\nState/UT,District-Before,District-After,Year\r\nT,"p\nq, ""r""",c,2003\r\n' + "\r\n".join(f'U,"p{i}\n\nx",d{i},2004' for i in range(400)) + "\r\n")
    (raw / "g.csv").write_text('State/UT,District-Before,District-After,Year\nT,"p,c,2003\nT,q,r,2004\n')
    manifest = spark.createDataFrame([("f.csv", "u7"), ("g.csv", "u8"), ("a.csv", "u1"), ("b.csv", "u2"), ("c.csv", "u3"), ("d.pdf", "u4"),
                                      ("e.csv", "u6"), ("gone.csv", "u5")], "filename string, url string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        ev = read_event_csvs(spark, manifest, str(raw)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    many = {(r["parent_district"].lower(), r["child_district"].lower()) for r in ev if r["source_url"] == "u7"}
    assert many == {('p\nq, "r"', "c")} | {(f"p{i}\n\nx", f"d{i}") for i in range(400)}
    ev = [r for r in ev if r["source_url"] != "u7"]
    got = sorted((r["event_type"], r["parent_district"], r["child_district"], r["effective_year"], r["source_url"])
                 for r in ev)
    assert got == [("RENAME", "X", "Y", "1991", "u2"), ("SPLIT", "Old One", "New One", "2001", "u1"),
                   ("SPLIT", "Parent Two", "Child, Two", "2002", "u6")]
    rejects = event_csv_rejects(spark, manifest, str(raw)).collect()
    assert sorted(map(tuple, rejects)) == [("c.csv", "unknown layout"), ("g.csv", "open quote"), ("gone.csv", "missing or empty")]


def test_jsonl_keeps_nulls_and_utf8(spark):
    df = spark.createDataFrame([(1, None, "Ärzte é"), (2, "x", None)], "id int, a string, b string")
    path = writers.write_jsonl(df.coalesce(1), scratch_path(spark, "test-jsonl"))
    lines = sorted(r["value"] for r in spark.read.text(path).collect())
    assert lines == ['{"id":1,"a":null,"b":"Ärzte é"}', '{"id":2,"a":"x","b":null}']
    back = writers.read_jsonl(spark, path, df.schema)
    assert sorted(back.collect()) == sorted(df.collect())


def test_csv_roundtrip_keeps_texts(spark):
    rows = [(1, "  padded "), (2, ""), (3, None), (4, 'line\nbreak,"q"'), (5, "x")]
    df = spark.createDataFrame(rows, "id int, s string")
    path = writers.write_csv(df, scratch_path(spark, "test-csv-text"))
    assert sorted(map(tuple, writers.read_csv(spark, path, df.schema).collect())) == rows


def test_arrow_reads_only_committed_files(spark):
    df = spark.range(0, 50)
    path = writers.write_arrow(df, scratch_path(spark, "test-arrow-commit"))
    local = path.removeprefix("file:")
    import os
    os.makedirs(f"{local}/_attempt-x")
    with open(f"{local}/_attempt-x/part-0.arrow", "w") as f:
        f.write("half a file of a lost task")
    assert writers.read_arrow(spark, path, df.schema).count() == 50
    writers.write_arrow(spark.range(0, 7), path)
    assert writers.read_arrow(spark, path, df.schema).count() == 7


def test_csv_roundtrip_keeps_microseconds(spark):
    df = spark.createDataFrame([(1, 'a,"b"')], "id int, s string").withColumn(
        "ts", F.lit("2024-01-02 03:04:05.123456").cast("timestamp_ntz"))
    path = writers.write_csv(df, scratch_path(spark, "test-csv"))
    assert writers.read_csv(spark, path, df.schema).collect() == df.collect()


def test_bronze_upsert_hot_hash(spark):
    # one record repeated for a third of the batch: merged to one row, first writer kept
    rows = [("hot" if i % 3 == 0 else f"h{i}", f"ds{i}", "r", "s", i) for i in range(3000)]
    b = spark.createDataFrame(rows, "source_record_hash string, source_dataset string, source_resource_id string, "
                                    "source_system string, seq int") \
        .withColumn("ingested_at", F.lit("2024-01-01").cast("timestamp_ntz")) \
        .withColumn("record", F.create_map(F.lit("k"), F.col("source_record_hash")))
    out = bronze.bronze_upsert(None, b.repartition(16), seq=["seq"])
    got = {r["source_record_hash"]: r["source_dataset"] for r in out.collect()}
    assert len(got) == 1 + 2000 and got["hot"] == "ds0"


def test_graph_nodes_first_writer_source_before_target(spark):
    edges = spark.createDataFrame(
        [("B", "A", "T", "2000", "s2", "e2", 2), ("A", "B", "T", "2000", "s1", "e1", 1),
         ("C", "A", "T", "2000", "s3", "e3", 1)],
        "source_district string, target_district string, event_type string, effective_year string, "
        "state string, source string, seq int")
    nodes = {r["district"]: r["source"] for r in graph.graph_nodes(edges, ["seq"]).collect()}
    # seq 1 has two edges in input order A->B then C->A; ties on seq break on the end (source first)
    assert nodes["B"] == "e1" and nodes["C"] == "e3"
    last = {(r["source_district"], r["target_district"]): r["source"] for r in graph.graph_edges(edges, ["seq"]).collect()}
    assert last == {("B", "A"): "e2", ("A", "B"): "e1", ("C", "A"): "e3"}


EDGE = "source_district string, target_district string"


def test_long_chain_is_proved_acyclic_in_few_rounds(spark, monkeypatch):
    n = 1000
    rows = [(f"n{i:05d}", f"n{i + 1:05d}") for i in range(n)]
    calls = []
    plain = graph._checkpoint
    monkeypatch.setattr(graph, "_checkpoint", lambda df: calls.append(1) or plain(df))
    assert graph.cyclic_core(spark.createDataFrame(rows, EDGE)).count() == 0
    assert len(calls) <= 20


def test_cyclic_core_keeps_rings_and_branches(spark):
    ring = [("r1", "r2"), ("r2", "r3"), ("r3", "r1")]  # inner nodes only
    fork = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("d", "e"), ("x", "a"), ("s", "s")]
    core = {tuple(r) for r in graph.cyclic_core(spark.createDataFrame(ring + fork, EDGE)).collect()}
    assert core == set(ring) | {("a", "b"), ("b", "c"), ("c", "a"), ("s", "s")}


def test_cycle_text_quotes_like_python(spark):
    names = ["B", "O'Brien", 'say "x"', "both ' and \"", "back\\slash"]
    df = spark.createDataFrame([(names,)], "c array<string>")
    assert df.select(graph.cycle_text(F.col("c"))).first()[0] == str(names)


def test_successor_pairs_without_exchange_reuse(spark):
    rows = [(0 if i % 3 == 0 else i % 40, (i * 7919) % 5000, i) for i in range(4000)]
    df = spark.createDataFrame(rows, "user_id long, ts long, event_id long")
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        pairs = successor_pairs(df, "user_id", ["ts", "event_id"], [], num_partitions=16)
        for _ in range(2):
            got = {(r["prev"]["event_id"], r["next"]["event_id"]) for r in pairs.collect()}
            order = sorted(rows)
            assert got == {(a[2], b[2]) for a, b in zip(order, order[1:]) if a[0] == b[0]}
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_html_spans():
    from granary.sources.html import parse_first_table

    head, body = parse_first_table(
        "<table><tr><th rowspan=2>State</th><th colspan=2>Rice</th></tr><tr><th>Area</th><th>Yield</th></tr>"
        "<tr><td rowspan=2>A</td><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr><tr><td>B</td><td colspan=2>5</td></tr></table>")
    assert head == [["State", "Rice", "Rice"], ["State", "Area", "Yield"]]
    assert body == [["A", "1", "2"], ["A", "3", "4"], ["B", "5", "5"]]


def test_page_reasons(spark):
    from granary.operators.records import page_reason

    pages = ['{"status":"ok","records":[]}', '{"status":"error","error":"x"}', "not json", '{"status":"ok","reco', None,
             "<html>No Data Found</html>", "<html><table></table></html>"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, p string")
    got = [r[0] for r in df.orderBy("i").select(page_reason(F.col("p"))).collect()]
    assert got == [None, "error", "malformed", "malformed", "malformed", "empty", None]


def test_runs_without_jobs(spark):
    from granary.operators import ledger

    jobs = spark.createDataFrame([("r1", 300)], "run_id string, offset_value long")
    runs = spark.createDataFrame([("r1",), ("r2",)], "run_id string")
    assert {tuple(r) for r in ledger.resume_frontier(jobs, 100, runs).collect()} == {("r1", 400), ("r2", 0)}
    done = spark.createDataFrame([("r1", "completed", None)], "run_id string, status string, started_at timestamp")
    assert [tuple(r) for r in ledger.latest_incomplete_run(done, "fresh").collect()] == [("fresh", None)]


def test_checkpoint_folder_is_needed_on_a_cluster(spark, monkeypatch):
    from granary import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    with pytest.raises(ValueError, match="checkpoint.dir"):
        session.shared_dir(Session())


def test_reference_validate_broadcasts_no_side(spark):
    """Exploded deletion keys look as small as the names; at size a broadcast of them fails the driver."""
    edges = spark.createDataFrame([("p", t, "SPLIT", "2000", "S", "f") for t in ("abc", "abd", "xyz", None)],
                                  "source_district string, target_district string, event_type string, "
                                  "effective_year string, state string, source string")
    directory = spark.createDataFrame([("abc",), (None,)], "name string")
    out = lineage.reference_validate(edges, directory)
    assert "Broadcast" not in out._jdf.queryExecution().sparkPlan().toString()
    assert {(r["district"], r["lgd_match"]) for r in out.collect()} == {("abc", True), ("abd", True), ("xyz", False), (None, False)}
