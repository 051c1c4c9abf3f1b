"""File sources: landed page envelopes, event CSVs listed in a manifest, the
alias map, and a checksum manifest of downloaded files."""

from __future__ import annotations

import hashlib
import re
import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.operators import lineage
from granary.schemas import PAGE
from granary.session import scratch_path

# the function that streams a file travels to executors by value, so they need no package
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LANDED_PAGE = T.StructType(
    [f for f in PAGE.fields] + [T.StructField("attempt", T.IntegerType())]
)


def read_landed_pages(spark: SparkSession, path: str, schema: T.StructType = LANDED_PAGE) -> DataFrame:
    """Pages written by :func:`granary.sinks.writers.write_raw_dated`, one
    row per page, with the partition columns (source/run/y/m/d) and the file
    each came from. Partition filters on y/m/d prune whole folders."""
    from granary.sinks.writers import TS_NTZ_FORMAT

    return (spark.read.schema(schema).option("timestampNTZFormat", TS_NTZ_FORMAT)
            .option("basePath", path).json(path)
            .withColumn("file_path", F.col("_metadata.file_path")))


#: files up to so many bytes are read as one value; larger ones are streamed
WHOLE_FILE = 256 << 20
_BLOCK = 1 << 20


def _open(path: str):
    """The bytes of a file by its Hadoop path: from a shared mount, else by Arrow's file systems (HDFS, object stores)."""
    scheme, found, rest = path.partition(":")
    if not found or scheme == "file":
        return open("/" + (rest if found else path).lstrip("/"), "rb")
    from pyarrow import fs

    host, _, key = rest.removeprefix("//").partition("/")
    system, base = fs.FileSystem.from_uri(f"{scheme}://{host}/")
    return system.open_input_stream(base.rstrip("/") + "/" + key)


def _streamed_checksums(batches):
    """SHA-256 of each file of ``path``, block by block."""
    for batch in batches:
        sums = []
        for path in batch["path"]:
            digest = hashlib.sha256()
            with _open(path) as f:
                while block := f.read(_BLOCK):
                    digest.update(block)
            sums.append(digest.hexdigest())
        yield batch.assign(checksum=sums)


def file_manifest(spark: SparkSession, path: str, glob: str | None = None, listing: DataFrame | None = None,
                  whole: int = WHOLE_FILE) -> DataFrame:
    """One row per file under ``path``: filename (relative to it), checksum
    (SHA-256), size, modification time; from ``listing`` (filename, source_url,
    download_date) the URL the file came from and when it was fetched.

    Executors read files of up to ``whole`` bytes as one value, in the JVM. Of larger ones only the
    listing comes by the scan; their bytes stream through a task in blocks of 1 MB, whatever the file's size.
    Spark's file listing leaves out files of zero bytes, so they have no row.
    """
    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    df = r.option("recursiveFileLookup", "true").load(path)
    small = df.where(F.col("length") <= whole).select("path", "length", "modificationTime", F.sha2("content", 256).alias("checksum"))
    large = df.where(F.col("length") > whole).select("path", "length", "modificationTime")
    schema = "path string, length long, modificationTime timestamp, checksum string"
    out = small.unionByName(large.mapInPandas(_streamed_checksums, schema)).select(
        _relative(F.col("path"), _qualified(spark, path)).alias("filename"),
        F.col("path").alias("source_path"),
        "checksum",
        F.col("length").alias("file_size"),
        F.col("modificationTime").cast("string").alias("last_modified"),
    )
    if listing is None:
        return out
    by = listing.groupBy("filename").agg(F.max_by("source_url", "download_date").alias("source_url"),
                                         F.max("download_date").alias("download_date"))
    return out.join(by, "filename", "left")


def _qualified(spark: SparkSession, path: str) -> str:
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(path.rstrip("/"))
    return base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(base).toString()


def _relative(file: Column, base: str) -> Column:
    """A file's path below ``base``; URIs differ in the slashes after the scheme."""
    bare = F.regexp_replace(file, "^([a-z0-9]+):/+", "$1:/")
    start = re.sub("^([a-z0-9]+):/+", r"\1:/", base)
    return F.substring(bare, F.lit(len(start) + 2), F.length(bare))


def read_alias_map(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Alias JSON (name -> canonical name) as a two-column table: one object
    per file, or with ``multi_line=False`` one object per line, which is how
    a table of any size is written by its tasks."""
    txt = spark.read.option("wholetext", multi_line).text(path)
    return txt.select(F.explode(F.from_json("value", "map<string,string>")).alias("alias", "canonical"))


def _listed_records(spark: SparkSession, manifest: DataFrame, raw_dir: str) -> tuple[DataFrame, DataFrame]:
    """(listed CSV files, their records: filename, url, start, record).

    A record ends at a line break outside quotes, wherever the file is split:
    a line starts one if the quotes before it in the file are even in number.
    Sums of quotes per split (one row each) and then within a split tell that.
    The lines are read once and written with their place (file, split, number),
    which everything after goes by. Records of several lines are put together
    by their first line's place; ``record`` is NULL in a file whose last quote
    is open.
    """
    listed = manifest.where(F.lower("filename").endswith(".csv")).groupBy("filename").agg(F.min("url").alias("url"))
    text = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.[cC][sS][vV]").option("lineSep", "\n").text(raw_dir)
            .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("at")))
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    path = scratch_path(spark, "event-lines")
    text.select(_relative(F.col("file"), _qualified(spark, raw_dir)).alias("filename"), "block", "at", "value", quotes.alias("n")).join(
        listed, "filename").write.parquet(path)
    lines = spark.read.parquet(path)
    own = Window.partitionBy("filename", "block").orderBy("at")
    before = F.coalesce(F.sum("n").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    splits = lines.groupBy("filename", "block").agg(F.sum("n").alias("of_split"))
    by_split = Window.partitionBy("filename").orderBy("block")
    splits = splits.select(
        "filename", "block", (F.sum("of_split").over(by_split) - F.col("of_split")).alias("earlier"),
        (F.sum("of_split").over(Window.partitionBy("filename")) % 2 == 1).alias("open"))
    placed = lines.withColumn("before", before).join(splits, ["filename", "block"])
    placed = placed.withColumn("starts", (F.col("before") + F.col("earlier")) % 2 == 0)
    here = F.struct("block", "at")
    alone = placed.where(F.col("starts") & ((F.col("n") % 2 == 0) | F.col("open"))).select(
        "filename", "url", here.alias("start"), F.when(~F.col("open"), F.col("value")).alias("record"))
    several = placed.where(~F.col("open") & ~(F.col("starts") & (F.col("n") % 2 == 0)))
    # the split that a record starts in, for lines of the next ones
    last = several.where("starts").groupBy("filename", "block").agg(F.max(here).alias("last")).join(splits.select("filename", "block"), ["filename", "block"], "right")
    carried = last.select("filename", "block", F.last("last", ignorenulls=True).over(by_split.rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    start = F.coalesce(F.last(F.when(F.col("starts"), here), ignorenulls=True).over(own), F.col("carried"))
    several = several.join(carried, ["filename", "block"]).withColumn("start", start)
    joined = several.groupBy("filename", "url", "start").agg(F.array_sort(F.collect_list(F.struct("block", "at", "value"))).alias("parts")).select(
        "filename", "url", "start", F.array_join(F.col("parts.value"), "\n").alias("record"))
    return listed, alone.unionByName(joined).withColumn("record", F.regexp_replace("record", r"\r\z", ""))


def _headers(records: DataFrame) -> DataFrame:
    """(filename, header, its place): the first record of each file that isn't blank."""
    first = records.where(F.col("record").isNull() | (F.col("record") != "")).groupBy("filename").agg(
        F.min_by("record", "start").alias("header"), F.min("start").alias("header_at"))
    return first.withColumn("header", F.regexp_replace("header", "^\uFEFF", ""))


def _layout_name(names: Column) -> Column:
    out = F.lit(None).cast("string")
    for lay in reversed(lineage.LAYOUTS):  # the first that fits wins
        fits = F.array_contains(names, lay["markers"][0]) & F.array_contains(names, lay["markers"][1])
        out = F.when(fits, F.lit(lay["name"])).otherwise(out)
    return out


def _fields(line: Column, width: int) -> Column:
    """The fields of a CSV line as an array of ``width`` texts."""
    names = [f"c{i}" for i in range(width)]
    row = F.from_csv(line, ", ".join(f"{n} string" for n in names), {"escape": '"', "multiLine": "true"})
    return F.array(*[row.getField(n) for n in names])


def _width(headers: DataFrame) -> int:
    """Fields of the widest header (commas plus one; a bound on the real number)."""
    row = headers.agg(F.max(F.length("header") - F.length(F.replace("header", F.lit(","), F.lit(""))))).first()
    return (row[0] or 0) + 1


def read_event_csvs(spark: SparkSession, manifest: DataFrame, raw_dir: str,
                    aliases: DataFrame | None = None) -> DataFrame:
    """Events from every CSV file listed in the manifest (filename, url).

    Every file is read by its own header: files of one layout may order their
    columns differently or hold further ones. All headers come from one
    distributed pass; each line then finds its fields by its file's header.
    The layout is the first whose markers the header holds. Files that give
    no events are listed by :func:`event_csv_rejects`; entries of other kinds
    are skipped. Quoted values may hold line breaks.
    """
    _, lines = _listed_records(spark, manifest, raw_dir)
    headers = _headers(lines)
    width = _width(headers)
    headers = headers.withColumn("names", _fields(F.col("header"), width)).withColumn("layout", _layout_name(F.col("names")))
    rows = lines.join(headers.drop("header"), "filename").where((F.col("start") != F.col("header_at")) & (F.col("record") != ""))
    rows = rows.select("layout", "names", F.col("filename").alias("source_document"), F.col("url").alias("source_url"),
                       _fields(F.col("record"), width).alias("fields"))

    def field(name: str, absent: str | None) -> Column:
        at = F.array_position("names", F.lit(name)).cast("int")
        return F.when(at > 0, F.element_at("fields", F.greatest(at, F.lit(1)))).otherwise(F.lit(absent)).alias(name)

    frames = []
    for lay in lineage.LAYOUTS:
        mine = rows.where(F.col("layout") == lay["name"]).select(
            field(lineage.STATE_COLUMN, ""), field(lay["parent"], None), field(lay["child"], None), field(lay["year"], None),
            "source_document", "source_url")
        frames.append(lineage.events_from_layout(mine, lay, aliases))
    return lineage.event_union(frames)


def event_csv_rejects(spark: SparkSession, manifest: DataFrame, raw_dir: str) -> DataFrame:
    """(filename, reason) of listed CSV files without events: ``missing or
    empty`` (no line was read), ``open quote`` or ``unknown layout``."""
    listed, lines = _listed_records(spark, manifest, raw_dir)
    headers = _headers(lines)
    known = _layout_name(_fields(F.col("header"), _width(headers)))
    j = listed.join(headers.select("filename", "header", "header_at", known.alias("layout")), "filename", "left")
    reason = F.when(F.col("header_at").isNull(), "missing or empty").when(F.col("header").isNull(), "open quote").otherwise("unknown layout")
    return j.where(F.col("layout").isNull()).select("filename", reason.alias("reason"))
