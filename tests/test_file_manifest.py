"""Checksums of files of any size: streamed ones equal those of whole values."""

import hashlib
import os

from granary.sources import files


def test_streamed_equal_whole(spark, tmp_path):
    contents = {"a.bin": b"", "b.bin": b"x" * 10, "sub dir/c 1.bin": os.urandom(3 << 20), "sub dir/d%20.bin": b"\x00\xff"}
    for name, data in contents.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)
    want = {(n, hashlib.sha256(d).hexdigest(), len(d)) for n, d in contents.items() if d}  # files without a byte have no row
    for whole in (files.WHOLE_FILE, 5, -1):
        got = files.file_manifest(spark, str(tmp_path), whole=whole).select("filename", "checksum", "file_size").collect()
        assert {tuple(r) for r in got} == want


def test_file_above_two_gigabytes(spark, tmp_path):
    """Three sparse GB: more than a JVM array holds."""
    size = 3 << 30
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size)
    digest, block = hashlib.sha256(), bytes(1 << 20)
    for _ in range(size >> 20):
        digest.update(block)
    row = files.file_manifest(spark, str(tmp_path)).select("checksum", "file_size").first()
    assert tuple(row) == (digest.hexdigest(), size)


def test_large_files_are_listed_without_their_bytes(spark, tmp_path):
    (tmp_path / "a.bin").write_bytes(b"abc")
    plan = files.file_manifest(spark, str(tmp_path), whole=1)._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInPandas" in plan and files.file_manifest(spark, str(tmp_path), whole=1).count() == 1


def test_supplier_files_are_written_by_all_cores(spark, tmp_path):
    """Few bytes in many files: merged into one partition, a single task would write them all."""
    import re

    from granary.plans import q_io
    from granary.session import shared_dir
    from granary.sinks.keyed_table import folders

    spark.range(40).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name").write.parquet(f"{tmp_path}/supplier.parquet")
    base = shared_dir(spark).rstrip("/") + "/granary"
    before = set(folders(spark, base))
    got = q_io.file_manifest(spark, str(tmp_path))
    [new] = [n for n in folders(spark, base) if n not in before and n.startswith("supplier-files")]
    written = spark.read.option("recursiveFileLookup", "true").text(f"{base}/{new}").inputFiles()
    assert len(written) == 40 and len({re.search(r"part-(\d+)", f)[1] for f in written}) > 1
    assert got.count() == 40
