"""Dynamic-schema keys: observed fields, new-field detection, catalogue,
evolution, schema diff, header flattening, dataset registration."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from granary.functions.headers import flatten_headers
from granary.operators import bronze, schema_ops
from granary.plans import crop, pages
from granary.plans.registry import query
from granary.plans.tables import load
from granary.session import scratch_path

KNOWN_FIELDS = ["k", "click"]
DATASET = "events-res"


def event_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event props (JSON object) plus one key named after the event type."""
    ev = load(spark, sf_dir, "events")
    props = F.from_json("props", "map<string,string>")
    return ev.select(
        "event_id", "ts",
        F.map_concat(props, F.create_map(F.col("event_type"), F.col("value").cast("string"))).alias("record"),
    )


def known_catalogue(spark: SparkSession) -> DataFrame:
    rows = [(DATASET, f, "double" if f == "k" else "unknown", "2023-12-31 00:00:00") for f in KNOWN_FIELDS]
    return spark.createDataFrame(rows, "dataset_id string, field_name string, field_type string, discovered_at string") \
        .withColumn("discovered_at", F.col("discovered_at").cast("timestamp_ntz"))


_KEYS_SQL = "SELECT unnest(json_keys(props)) AS field_name, ts FROM events UNION ALL SELECT event_type, ts FROM events"


@query("schema_union_agg", f"SELECT DISTINCT field_name FROM ({_KEYS_SQL}) k")
def schema_union_agg(spark, sf_dir):
    return bronze.observed_fields(event_records(spark, sf_dir))


@query(
    "detect_new_fields",
    f"SELECT DISTINCT field_name FROM ({_KEYS_SQL}) k WHERE field_name NOT IN ({', '.join(repr(f) for f in KNOWN_FIELDS)})",
)
def detect_new_fields(spark, sf_dir):
    return bronze.detect_new_fields(event_records(spark, sf_dir), known_catalogue(spark))


@query(
    "catalogue_upsert",
    f"""SELECT '{DATASET}' AS dataset_id, 'k' AS field_name, 'double' AS field_type, TIMESTAMP '2023-12-31 00:00:00' AS discovered_at
UNION ALL SELECT '{DATASET}', 'click', 'unknown', TIMESTAMP '2023-12-31 00:00:00'
UNION ALL SELECT '{DATASET}', field_name, 'unknown', min(ts) FROM ({_KEYS_SQL}) k
  WHERE field_name NOT IN ({', '.join(repr(f) for f in KNOWN_FIELDS)}) GROUP BY field_name""",
)
def catalogue_upsert(spark, sf_dir):
    r = event_records(spark, sf_dir)
    found = r.select("event_id", "ts", F.explode(F.map_keys("record")).alias("field_name")).select(
        F.lit(DATASET).alias("dataset_id"), "field_name", F.col("ts").alias("discovered_at"), "event_id"
    )
    return bronze.catalogue_upsert(known_catalogue(spark), found, seq=["discovered_at", "event_id"])


@query(
    "schema_evolve",
    """SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
  CAST(NULL AS VARCHAR) AS c_mktsegment FROM customer WHERE c_acctbal >= 0
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(c_nationkey AS VARCHAR), c_mktsegment FROM customer WHERE c_acctbal < 0""",
)
def schema_evolve(spark, sf_dir):
    """Three batches on disk, the later two with a field that the first doesn't have; its rows get NULL there
    when all files are read as one table."""
    c = load(spark, sf_dir, "customer")
    path = scratch_path(spark, "evolving")
    fields = ["c_custkey", "c_name", "c_nationkey"]
    early, late = c.where(F.col("c_acctbal") >= 0), c.where(F.col("c_acctbal") < 0)
    even = F.col("c_custkey") % 2 == 0
    for rows, names in ((early, fields), (late.where(even), [*fields, "c_mktsegment"]), (late.where(~even), [*fields, "c_mktsegment"])):
        record = rows.select(bronze.columns_to_record(names).alias("record"))
        bronze.append_evolved(bronze.promote_record(record, names), path)
    return bronze.read_evolved(spark, path)


@query(
    "schema_diff",
    """WITH l AS (SELECT regexp_replace(column_name, '^[a-z]_', '') AS column_name, ordinal_position AS p
              FROM information_schema.columns WHERE table_name = 'customer'),
     r AS (SELECT regexp_replace(column_name, '^[a-z]_', '') AS column_name, ordinal_position AS p
              FROM information_schema.columns WHERE table_name = 'supplier')
SELECT coalesce(l.column_name, r.column_name) AS column_name, CAST(l.p AS INTEGER) AS left_position,
  CAST(r.p AS INTEGER) AS right_position,
  CASE WHEN l.p IS NULL THEN 'right_only' WHEN r.p IS NULL THEN 'left_only' ELSE 'both' END AS presence
FROM l FULL OUTER JOIN r ON l.column_name = r.column_name""",
)
def schema_diff(spark, sf_dir):
    def unprefixed(df):
        return df.toDF(*[c.split("_", 1)[1] for c in df.columns])

    left = unprefixed(load(spark, sf_dir, "customer"))
    right = unprefixed(load(spark, sf_dir, "supplier"))
    return schema_ops.schema_diff(spark, left, right)


_PARTS_SQL = "[p_type, 'Unnamed: 1_level_0', p_type, ' ' || p_name || ' ', p_brand]"


@query(
    "flatten_headers",
    f"""SELECT p_partkey, trim(regexp_replace(regexp_replace(array_to_string(
   list_filter(l, lambda x, i: i = 1 OR x <> l[i - 1]), '_'), '[^a-zA-Z0-9_]', '_', 'g'), '_+', '_', 'g'), '_') AS column_name
FROM (SELECT p_partkey, list_transform(list_filter({_PARTS_SQL}, lambda p: NOT contains(p, 'Unnamed')),
        lambda p: trim(p)) AS l FROM part) x""",
)
def flatten_headers_q(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    parts = F.array("p_type", F.lit("Unnamed: 1_level_0"), "p_type",
                    F.concat(F.lit(" "), F.col("p_name"), F.lit(" ")), "p_brand")
    return p.select("p_partkey", flatten_headers(parts).alias("column_name"))


@query(
    "dataset_register",
    f"""SELECT '{crop.RESOURCE_ID}' AS dataset_id, 'Crop statistics (registered earlier)' AS dataset_name,
  '{crop.RESOURCE_ID}' AS resource_id, 'tables' AS source_name
UNION ALL
SELECT DISTINCT '{pages.RESOURCE_ID}', '{pages.DATASET_NAME}', '{pages.RESOURCE_ID}', 'api' FROM orders""",
)
def dataset_register(spark, sf_dir):
    registry = spark.createDataFrame(
        [(crop.RESOURCE_ID, "Crop statistics (registered earlier)", crop.RESOURCE_ID, "tables")],
        T.StructType([T.StructField(n, T.StringType()) for n in
                      ["dataset_id", "dataset_name", "resource_id", "source_name"]]),
    )
    return schema_ops.dataset_register(registry, pages.orders_pages(spark, sf_dir))
