"""Bronze layer: stringified records, lineage columns, keyed upsert, dynamic
schema (field catalogue, new-field detection, evolution)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from granary.functions.hashing import record_hash
from granary.functions.numeric import py_float_text
from granary.sinks.keyed_table import KeyedTable, Stage

LINEAGE_COLUMNS = ["source_record_hash", "source_dataset", "source_resource_id", "source_system", "ingested_at"]
# Prefix given to payload keys that collide with a lineage column (trap T9).
PAYLOAD_PREFIX = "payload_"


def stringify(record: Column) -> Column:
    """Every payload value as text; NULL stays NULL."""
    return F.transform_values(record, lambda k, v: v.cast("string"))


def row_record(df: DataFrame, cols: list[str]) -> Column:
    """A row's columns as a text record, each value as Python's ``str`` prints it; NULL stays NULL."""
    kinds = dict(df.dtypes)

    def text(c: str) -> Column:
        if kinds[c] in ("double", "float"):
            return py_float_text(F.col(c).cast("double"))
        if kinds[c] == "boolean":
            return F.initcap(F.col(c).cast("string"))
        return F.col(c).cast("string")

    return F.create_map(*[x for c in cols for x in (F.lit(c), text(c))])


def columns_to_record(cols: list[str]) -> Column:
    """Typed columns -> ``map<string,string>`` record, keys in the given order."""
    return F.create_map(*[x for c in cols for x in (F.lit(c), F.col(c).cast("string"))])


def enrich(records: DataFrame, *, source_dataset: str | Column, source_resource_id: str | Column,
           source_system: str | Column, record_col: str = "record") -> DataFrame:
    """Add the four lineage columns; the hash covers the stringified record."""
    def _c(v):
        return v if isinstance(v, Column) else F.lit(v)

    return records.withColumns(
        {
            "source_dataset": _c(source_dataset),
            "source_resource_id": _c(source_resource_id),
            "source_system": _c(source_system),
            "source_record_hash": record_hash(F.col(record_col)),
        }
    )


def bronze_upsert(existing: DataFrame | None, batch: DataFrame, *, seq: list[str],
                  record_col: str = "record") -> DataFrame:
    """Keyed merge on ``source_record_hash``.

    ``batch`` carries the lineage columns, ``ingested_at`` and the record map;
    ``seq`` orders its rows (arrival). The first insert fixes
    dataset/resource/system; a repeat refreshes ``ingested_at`` (max) and the
    payload (last arrival). Output adds ``was_present`` / ``in_batch`` flags so
    insert/update counts come from the same pass.

    The batch is pre-aggregated per hash (map-side partial aggregation, so a
    hot hash never lands whole on one task), then full-outer joined with the
    existing rows on the hash. :func:`merge_into` is the form that changes a
    stored table: it passes the touched slots of a table bucketed by the hash,
    which the join does not shuffle.
    """
    return _join(existing, _reduced(batch, seq, record_col), record_col)


def _reduced(batch: DataFrame, seq: list[str], record_col: str) -> DataFrame:
    """One row per hash: the first row's lineage, the last one's record, the latest time."""
    order = F.struct(*[F.col(c) for c in seq])
    return batch.groupBy("source_record_hash").agg(
        F.min_by(
            F.struct("source_dataset", "source_resource_id", "source_system"), order
        ).alias("first"),
        F.max("ingested_at").alias("b_ingested_at"),
        F.max_by(F.col(record_col), order).alias("b_record"),
    )


def _join(existing: DataFrame | None, b: DataFrame, record_col: str) -> DataFrame:
    if existing is None:
        return b.select(
            "source_record_hash",
            F.col("first.source_dataset").alias("source_dataset"),
            F.col("first.source_resource_id").alias("source_resource_id"),
            F.col("first.source_system").alias("source_system"),
            F.col("b_ingested_at").alias("ingested_at"),
            F.col("b_record").alias(record_col),
            F.lit(False).alias("was_present"),
            F.lit(True).alias("in_batch"),
        )
    e = existing.select(
        "source_record_hash",
        F.col("source_dataset").alias("e_dataset"),
        F.col("source_resource_id").alias("e_resource"),
        F.col("source_system").alias("e_system"),
        F.col("ingested_at").alias("e_ingested_at"),
        F.col(record_col).alias("e_record"),
        F.lit(True).alias("e_flag"),
    )
    j = e.join(b, "source_record_hash", "full_outer")
    present = F.coalesce(F.col("e_flag"), F.lit(False))
    in_batch = F.col("first").isNotNull()
    return j.select(
        "source_record_hash",
        F.when(present, F.col("e_dataset")).otherwise(F.col("first.source_dataset")).alias("source_dataset"),
        F.when(present, F.col("e_resource")).otherwise(F.col("first.source_resource_id")).alias("source_resource_id"),
        F.when(present, F.col("e_system")).otherwise(F.col("first.source_system")).alias("source_system"),
        F.greatest(F.col("e_ingested_at"), F.col("b_ingested_at")).alias("ingested_at"),
        F.when(in_batch, F.col("b_record")).otherwise(F.col("e_record")).alias(record_col),
        present.alias("was_present"),
        in_batch.alias("in_batch"),
    )


def merge_into(table: KeyedTable, batch: DataFrame | Stage, *, seq: list[str], record_col: str = "record", mark: int | None = None) -> dict:
    """:func:`bronze_upsert` into a table in place: only the slots that the
    batch's hashes fall into are read, joined (without an exchange of the base)
    and written, some at a time. The batch is reduced to a row per hash first. Returns the counts of ``new`` and ``old`` hashes of the batch,
    observed on these writes."""
    watches: list[Observation] = []

    def combine(base: DataFrame | None, rows: DataFrame) -> DataFrame:
        watches.append(Observation())
        return _join(base, rows, record_col).observe(
            watches[-1], F.count_if(F.col("in_batch") & ~F.col("was_present")).alias("new"),
            F.count_if(F.col("in_batch") & F.col("was_present")).alias("old"))

    table.merge(batch, combine, mark, lambda rows: _reduced(rows, seq, record_col))
    return {name: sum(w.get[name] for w in watches) for name in ("new", "old")}


def observed_fields(records: DataFrame, record_col: str = "record", by: list[str] | None = None) -> DataFrame:
    """Union of keys over all records (distinct; partial aggregation)."""
    by = by or []
    return records.select(*by, F.explode(F.map_keys(F.col(record_col))).alias("field_name")).distinct()


def detect_new_fields(records: DataFrame, catalogue: DataFrame, record_col: str = "record",
                      dataset_col: str | None = None) -> DataFrame:
    """Observed keys minus catalogue keys (per dataset when given)."""
    by = [dataset_col] if dataset_col else []
    obs = observed_fields(records, record_col, by)
    if dataset_col:
        cat = catalogue.select(F.col("dataset_id").alias(dataset_col), "field_name")
        return obs.join(cat, [dataset_col, "field_name"], "left_anti")
    return obs.join(catalogue.select("field_name"), "field_name", "left_anti")


def catalogue_upsert(catalogue: DataFrame, discovered: DataFrame, *, seq: list[str]) -> DataFrame:
    """Insert-if-absent of (dataset_id, field_name); first write wins.

    ``discovered`` has dataset_id, field_name, optional field_type (default
    ``unknown``) and the ordering columns ``seq``.
    """
    d = discovered
    if "field_type" not in d.columns:
        d = d.withColumn("field_type", F.lit(None).cast("string"))
    d = d.withColumn("field_type", F.coalesce(F.col("field_type"), F.lit("unknown")))
    order = F.struct(*[F.col(c) for c in seq])
    first = d.groupBy("dataset_id", "field_name").agg(
        F.min_by(F.struct("field_type", "discovered_at"), order).alias("w")
    ).select("dataset_id", "field_name", "w.field_type", "w.discovered_at")
    new = first.join(catalogue.select("dataset_id", "field_name"), ["dataset_id", "field_name"], "left_anti")
    return catalogue.select("dataset_id", "field_name", "field_type", "discovered_at").unionByName(new)


def field_name_of(field: Column) -> Column:
    """Catalogue name of a declared field: ``id``, else ``name``."""
    return F.coalesce(F.nullif(field.getField("id"), F.lit("")), field.getField("name"))


def promote_record(records: DataFrame, fields: list[str], record_col: str = "record") -> DataFrame:
    """Map payload -> one text column per known field (bronze table shape).

    ``fields`` comes from the catalogue (a schema, so its size is the column
    count). A field named like a lineage column is renamed with a prefix.
    """
    reserved = set(LINEAGE_COLUMNS) | {"id"}
    base = [c for c in records.columns if c != record_col]
    cols = [
        F.try_element_at(F.col(record_col), F.lit(f)).alias(PAYLOAD_PREFIX + f if f in reserved else f)
        for f in sorted(fields)
    ]
    return records.select(*base, *cols)


def schema_evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Widen by new text columns; old rows get NULL in them (no drop/retype)."""
    return old.unionByName(new, allowMissingColumns=True)


def append_evolved(batch: DataFrame, path: str) -> None:
    """Add a batch with whatever columns it has; files from before stay as they are."""
    batch.write.mode("append").parquet(path)


def read_evolved(spark: SparkSession, path: str) -> DataFrame:
    """All batches as one table: the columns of all files (their footers are merged when the plan is built),
    NULL where a file lacks one. A column keeps one type for good; bronze columns are text."""
    return spark.read.option("mergeSchema", "true").parquet(path)
