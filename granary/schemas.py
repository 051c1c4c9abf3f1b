"""Fixed schemas of the datasets the operators exchange (see FIXTURES.md)."""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
RECORD = T.MapType(S, S, True)

FIELD = T.StructType([T.StructField("id", S), T.StructField("name", S), T.StructField("type", S)])

# Page envelope as landed by a JSON source (F6). ``total`` is text because
# sources send it either as a number or a string.
ENVELOPE = T.StructType(
    [
        T.StructField("title", S),
        T.StructField("status", S),
        T.StructField("error", S),
        T.StructField("total", S),
        T.StructField("field", T.ArrayType(FIELD)),
        T.StructField("records", T.ArrayType(RECORD)),
    ]
)

# One row per fetched page (the source-adapter contract).
PAGE = T.StructType(
    [
        T.StructField("source_system", S),
        T.StructField("resource_id", S),
        T.StructField("run_id", S),
        T.StructField("offset", T.LongType()),
        T.StructField("limit", T.IntegerType()),
        T.StructField("request_url", S),
        T.StructField("request_params", RECORD),
        T.StructField("raw_json", S),
        T.StructField("fetched_at", T.TimestampNTZType()),
    ]
)

SILVER = T.StructType(
    [
        T.StructField("state_name", S),
        T.StructField("district_name", S),
        T.StructField("crop_name", S),
        T.StructField("season", S),
        T.StructField("year", S),
        T.StructField("area_hectare", T.DoubleType()),
        T.StructField("production_tonnes", T.DoubleType()),
        T.StructField("yield_ton_per_hectare", T.DoubleType()),
        T.StructField("source_record_hash", S),
    ]
)

ISSUE = T.StructType(
    [
        T.StructField("record_hash", S),
        T.StructField("field_name", S),
        T.StructField("issue_type", S),
        T.StructField("issue_detail", S),
        T.StructField("severity", S),
    ]
)

EVENT = T.StructType(
    [
        T.StructField("state", S),
        T.StructField("parent_district", S),
        T.StructField("child_district", S),
        T.StructField("event_type", S),
        T.StructField("effective_date", T.DateType()),
        T.StructField("effective_year", S),
        T.StructField("notification_date", T.DateType()),
        T.StructField("source_document", S),
        T.StructField("source_url", S),
        T.StructField("remarks", S),
    ]
)

EDGE = T.StructType(
    [
        T.StructField("source_district", S),
        T.StructField("target_district", S),
        T.StructField("event_type", S),
        T.StructField("effective_year", S),
        T.StructField("state", S),
        T.StructField("source", S),
    ]
)

JOB = T.StructType(
    [
        T.StructField("run_id", S),
        T.StructField("offset_value", T.LongType()),
        T.StructField("status", S),
        T.StructField("records_fetched", T.LongType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("error_message", S),
    ]
)

CATALOGUE = T.StructType(
    [
        T.StructField("dataset_id", S),
        T.StructField("field_name", S),
        T.StructField("field_type", S),
        T.StructField("discovered_at", T.TimestampNTZType()),
    ]
)

MANIFEST = T.StructType(
    [
        T.StructField("filename", S),
        T.StructField("source_url", S),
        T.StructField("download_date", S),
        T.StructField("checksum", S),
        T.StructField("file_size", T.LongType()),
        T.StructField("last_modified", S),
    ]
)

JOB_STATUSES = ["pending", "running", "completed", "failed"]
RUN_STATUSES = ["running", "completed", "failed"]
