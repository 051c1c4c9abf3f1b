"""Session helpers.

Library code never changes global confs of a session it is handed. The only
session this module builds is the one used by tests and ``bench.py``.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import suppress

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the local bench (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("granary")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        # HotSpot compiles no method above 8000 bytes; Spark's own limit for generated ones is 64 KB
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this is set by the operator and points at storage every
    executor can reach. A session that has none gets one under the system temp
    folder if its master is local (tests); on a cluster that folder would be
    one machine's disk, so the call fails.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if not current:
        conf = spark.conf.get("spark.checkpoint.dir", None)
        if conf:
            sc.setCheckpointDir(conf)
        elif not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        else:
            sc.setCheckpointDir(tempfile.mkdtemp(prefix="granary-ckpt-"))
        current = sc.getCheckpointDir()
    return current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/granary/{name}-{uuid.uuid4().hex[:12]}"


def release(spark: SparkSession) -> None:
    """Free the disk of shuffles that no plan refers to any more: Spark deletes them when the driver's collector
    has found that, which by itself may be long after the write that they were for. The listeners hold the last
    query until they have seen another one."""
    spark.sql("SELECT 1").collect()
    with suppress(Py4JJavaError):  # a slow listener: what it holds goes the next time
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    spark.sparkContext._jvm.System.gc()


def local_fs_path(path: str) -> str:
    """Strip a ``file:`` scheme (used only where a local path is required)."""
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
    return os.path.abspath(path)
