"""Sinks: exports in CSV, Parquet, JSON lines and Arrow IPC; the dated raw
page layout; node-link graph files; lineage reports.

All writers are distributed (one file per task); paths should be on storage
every executor reaches.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from granary.session import release
from granary.sinks.arrow_source import register as register_arrow

# Full microsecond precision for NTZ timestamps in text formats (the default
# pattern would cut them to milliseconds).
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
EXPORT_PREFIX = "crop_statistics_raw_"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV with header; padding is kept, an empty text is ``""``, NULL is nothing."""
    (df.write.mode(mode).option("header", True).option("timestampNTZFormat", TS_NTZ_FORMAT)
     .option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .csv(path))
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """JSON lines; NULL fields are written as ``null``, UTF-8 kept as is."""
    (df.write.mode(mode).option("ignoreNullFields", "false").option("timestampNTZFormat", TS_NTZ_FORMAT)
     .json(path))
    return path


def write_arrow(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """Arrow IPC files (Feather v2), one per task, via the Python data source."""
    register_arrow(df.sparkSession)
    df.write.format("arrow").mode(mode).save(qualified(df.sparkSession, path))
    return path


# What an unquoted empty field reads as before it becomes NULL; no text holds it.
_CSV_NULL = "\u0000"


def read_csv(spark, path: str, schema) -> DataFrame:
    """What :func:`write_csv` wrote, value for value: also texts with line
    breaks (a file is then read by one task; writers make one file per task)."""
    return (spark.read.schema(schema).option("header", True).option("timestampNTZFormat", TS_NTZ_FORMAT)
            .option("escape", '"').option("multiLine", True).option("nullValue", _CSV_NULL).option("emptyValue", "").csv(path))


def read_jsonl(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).option("timestampNTZFormat", TS_NTZ_FORMAT).json(path)


def read_arrow(spark, path: str, schema) -> DataFrame:
    register_arrow(spark)
    return spark.read.format("arrow").schema(schema).load(qualified(spark, path))


def qualified(spark, path: str) -> str:
    """The path with its file system; one without a scheme is on the default file system, not on
    each executor's own disk."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def timestamped_name(ts, extension: str) -> F.Column:
    """``crop_statistics_raw_<yyyyMMdd_HHmmss>.<ext>`` from a timestamp column."""
    return F.concat(F.lit(EXPORT_PREFIX), F.date_format(ts, "yyyyMMdd_HHmmss"), F.lit("." + extension))


def timestamped_path(base: str, extension: str, now: _dt.datetime | None = None) -> str:
    """The export file name for a run started at ``now`` (UTC)."""
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return f"{base.rstrip('/')}/{EXPORT_PREFIX}{now.strftime('%Y%m%d_%H%M%S')}.{extension}"


def write_raw_dated(pages: DataFrame, path: str, ts_col: str = "fetched_at") -> str:
    """Landed pages under ``source/run/y/m/d`` partitions (trap T12 fix:
    source and run are part of the layout, the whole payload is kept)."""
    ts = F.col(ts_col)
    out = pages.withColumns({
        "y": F.date_format(ts, "yyyy"), "m": F.date_format(ts, "MM"), "d": F.date_format(ts, "dd"),
    })
    (out.write.mode("append").partitionBy("source_system", "run_id", "y", "m", "d")
     .option("timestampNTZFormat", TS_NTZ_FORMAT).json(path))
    return path


def write_node_link(nodes: DataFrame, links: DataFrame, path: str) -> tuple[str, str]:
    """Graph as two JSON-lines datasets, ``nodes/`` and ``links/``."""
    write_jsonl(nodes, f"{path}/nodes")
    write_jsonl(links, f"{path}/links")
    return f"{path}/nodes", f"{path}/links"


def write_reports(reports: dict[str, DataFrame], path: str) -> dict[str, str]:
    """Each named report as a CSV dataset with header; what one leaves in memory and on disk goes before the next."""
    out = {}
    for name, df in reports.items():
        out[name] = write_csv(df, f"{path}/{name}")
        release(df.sparkSession)
    return out
