"""Orders packed into page envelopes of ``PAGE_SIZE`` records (bounded
``collect_list`` per page), the shape a paged JSON source lands."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.urls import request_url
from granary.plans.tables import load

PAGE_SIZE = 100
BASE_URL = "https://api.example/resource/orders"
RESOURCE_ID = "orders-res"
DATASET_NAME = "Orders"
ORDER_KEYS = ["o_custkey", "o_orderdate", "o_orderkey", "o_orderpriority", "o_orderstatus", "o_totalprice"]
FIELDS = [("o_orderkey", "Order Key", "double"), ("o_custkey", "Customer", "double"),
          ("o_orderstatus", "Status", "keyword"), ("o_totalprice", "Total Price", "double"),
          ("o_orderdate", "Order Date", "date"), ("o_orderpriority", "Priority", "keyword")]
ERROR_PRICE = 495000.0  # pages holding such an order first fail once


def order_record_fields(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey"),
        F.col("o_custkey").cast("string").alias("t_custkey"),
        F.to_date("o_orderdate").cast("string").alias("t_orderdate"),
        F.col("o_orderkey").cast("string").alias("t_orderkey"),
        F.col("o_orderpriority").alias("t_orderpriority"),
        F.col("o_orderstatus").alias("t_orderstatus"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("string").alias("t_totalprice"),
        F.col("o_totalprice"),
    )


def orders_pages(spark: SparkSession, sf_dir: str, run_id: str = "run-orders") -> DataFrame:
    """One row per page attempt (PAGE schema + ``attempt``)."""
    orders = load(spark, sf_dir, "orders")
    f = order_record_fields(orders)
    def rec(x):
        return F.create_map(*[y for k in ORDER_KEYS for y in (F.lit(k), x.getField("t_" + k[2:]))])
    total = orders.count()
    fields = F.array(*[
        F.struct(F.lit(i).alias("id"), F.lit(n).alias("name"), F.lit(t).alias("type")) for i, n, t in FIELDS
    ])
    page = (F.col("o_orderkey") / PAGE_SIZE).cast("bigint")
    grouped = f.groupBy(page.alias("page_id")).agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", *["t_" + k[2:] for k in ORDER_KEYS]))).alias("rs"),
        F.max("o_totalprice").alias("mx"),
    )
    ok = F.struct(F.lit(1).alias("attempt"), F.to_json(F.struct(
        F.lit(DATASET_NAME).alias("title"), F.lit("ok").alias("status"), F.lit(str(total)).alias("total"),
        fields.alias("field"), F.transform("rs", rec).alias("records"),
    )).alias("raw_json"))
    bad = F.struct(F.lit(0).alias("attempt"), F.to_json(F.struct(
        F.lit("error").alias("status"), F.lit("rate limited").alias("error"))).alias("raw_json"))
    attempts = F.when(F.col("mx") > ERROR_PRICE, F.array(bad, ok)).otherwise(F.array(ok))
    env = grouped.select("page_id", F.explode(attempts).alias("a")).select("page_id", "a.attempt", "a.raw_json")
    offset = (F.col("page_id") * PAGE_SIZE).cast("bigint")
    return env.select(
        F.lit("api").alias("source_system"), F.lit(RESOURCE_ID).alias("resource_id"), F.lit(run_id).alias("run_id"),
        offset.alias("offset"), F.lit(PAGE_SIZE).alias("limit"),
        request_url(BASE_URL, offset, F.lit(PAGE_SIZE)).alias("request_url"),
        F.create_map(F.lit("api-key"), F.lit("k-123"), F.lit("format"), F.lit("json"),
                     F.lit("offset"), offset.cast("string"), F.lit("limit"), F.lit(str(PAGE_SIZE))).alias("request_params"),
        "raw_json",
        F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("fetched_at"),
        "attempt",
    )


def record_columns(df: DataFrame, record_col: str = "record") -> list:
    """Order fields pulled back out of a record map, typed as text."""
    return [F.col(record_col).getItem(k).alias(k) for k in ORDER_KEYS]


ORDER_TEXT_SQL = """SELECT o_orderkey,
  CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate,
  CAST(o_orderkey AS VARCHAR) AS t_orderkey, o_orderpriority, o_orderstatus,
  CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS o_totalprice, o_totalprice AS price
FROM orders"""


def customer_record(prefix_cols: bool = False):
    """Customer row as a text record (keys in name order)."""
    return F.create_map(
        F.lit("c_acctbal"), F.col("c_acctbal").cast("decimal(12,2)").cast("string"),
        F.lit("c_custkey"), F.col("c_custkey").cast("string"),
        F.lit("c_mktsegment"), F.col("c_mktsegment"),
        F.lit("c_name"), F.col("c_name"),
        F.lit("c_nationkey"), F.col("c_nationkey").cast("string"),
    )


def supplier_record():
    return F.create_map(
        F.lit("s_acctbal"), F.col("s_acctbal").cast("decimal(12,2)").cast("string"),
        F.lit("s_name"), F.col("s_name"),
        F.lit("s_nationkey"), F.col("s_nationkey").cast("string"),
        F.lit("s_suppkey"), F.col("s_suppkey").cast("string"),
    )


CUSTOMER_MAP_SQL = ("MAP {'c_acctbal': CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), "
                    "'c_custkey': CAST(c_custkey AS VARCHAR), 'c_mktsegment': c_mktsegment, 'c_name': c_name, "
                    "'c_nationkey': CAST(c_nationkey AS VARCHAR)}")
SUPPLIER_MAP_SQL = ("MAP {'s_acctbal': CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR), 's_name': s_name, "
                    "'s_nationkey': CAST(s_nationkey AS VARCHAR), 's_suppkey': CAST(s_suppkey AS VARCHAR)}")
CUSTOMER_HASH_SQL = f"sha256(to_json({CUSTOMER_MAP_SQL}))"
SUPPLIER_HASH_SQL = f"sha256(to_json({SUPPLIER_MAP_SQL}))"
