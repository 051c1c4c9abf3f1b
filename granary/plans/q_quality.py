"""README sample queries, data-quality rules and the validation summary, over
the crop silver layer derived from the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.operators import quality
from granary.plans.crop import CROP_SILVER_SQL, crop_silver
from granary.plans.registry import query

SILVER_CTE = f"WITH s AS ({CROP_SILVER_SQL})\n"


def exact_sum(c, scale: int = 2):
    """Sum of a measure recorded to ``scale`` decimals, added as decimals so
    the result does not depend on addition order, returned as double."""
    return F.sum(c.cast(f"decimal(18,{scale})")).cast("double")


@query("q_total_records", SILVER_CTE + "SELECT count(*) AS total_records FROM s")
def q_total_records(spark, sf_dir):
    return crop_silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_records"))


@query(
    "q_records_per_state",
    SILVER_CTE + "SELECT state_name, count(*) AS record_count FROM s GROUP BY state_name ORDER BY record_count DESC, state_name",
)
def q_records_per_state(spark, sf_dir):
    return (
        crop_silver(spark, sf_dir)
        .groupBy("state_name")
        .agg(F.count(F.lit(1)).alias("record_count"))
        .orderBy(F.desc("record_count"), "state_name")
    )


@query(
    "q_top_crops",
    SILVER_CTE
    + """SELECT crop_name, CAST(sum(CAST(production_tonnes AS DECIMAL(18,2))) AS DOUBLE) AS total_production
FROM s WHERE production_tonnes IS NOT NULL GROUP BY crop_name
ORDER BY total_production DESC, crop_name NULLS FIRST LIMIT 20""",
)
def q_top_crops(spark, sf_dir, n: int = 20):
    return (
        crop_silver(spark, sf_dir)
        .where(F.col("production_tonnes").isNotNull())
        .groupBy("crop_name")
        .agg(exact_sum(F.col("production_tonnes")).alias("total_production"))
        .orderBy(F.desc("total_production"), F.asc_nulls_first("crop_name"))
        .limit(n)
    )


DQ_NULL_SQL = "\nUNION ALL\n".join(
    f"SELECT source_record_hash AS record_hash, '{c}' AS field_name, 'null_value' AS issue_type, "
    f"'{c} is null' AS issue_detail, 'warning' AS severity FROM s WHERE {c} IS NULL"
    for c in quality.NULL_CHECK_COLUMNS
)
DQ_NEG_SQL = "\nUNION ALL\n".join(
    f"SELECT source_record_hash AS record_hash, '{c}' AS field_name, 'negative_value' AS issue_type, "
    f"'{c} = ' || CAST({c} AS VARCHAR) AS issue_detail, 'error' AS severity FROM s WHERE {c} < 0"
    for c in quality.NEGATIVE_CHECK_COLUMNS
)
DQ_YEAR_SQL = (
    "SELECT source_record_hash AS record_hash, 'year' AS field_name, 'invalid_year' AS issue_type, "
    "'year = ''' || year || '''' AS issue_detail, 'warning' AS severity FROM s "
    "WHERE year IS NOT NULL AND NOT regexp_full_match(regexp_replace(year, '^\\s+|\\s+$', '', 'g'), '\\d{4}(-\\d{2,4})?')"
)
DQ_NAME_SQL = "\nUNION ALL\n".join(
    f"SELECT source_record_hash AS record_hash, '{c}' AS field_name, 'malformed_name' AS issue_type, "
    f"'{c} = ''' || {c} || ''' contains digits' AS issue_detail, 'info' AS severity FROM s "
    f"WHERE {c} IS NOT NULL AND {c} <> '' AND regexp_matches({c}, '\\d')"
    for c in quality.NAME_CHECK_COLUMNS
)
DQ_ALL_SQL = "\nUNION ALL\n".join([DQ_NULL_SQL, DQ_NEG_SQL, DQ_YEAR_SQL, DQ_NAME_SQL])


def _dq(rules):
    def build(spark, sf_dir):
        return quality.issues(crop_silver(spark, sf_dir, dealt=True), rules)

    return build


query("dq_null", SILVER_CTE + DQ_NULL_SQL)(_dq(["null"]))
query("dq_negative", SILVER_CTE + DQ_NEG_SQL)(_dq(["negative"]))
query("dq_year", SILVER_CTE + DQ_YEAR_SQL)(_dq(["year"]))
query("dq_malformed_name", SILVER_CTE + DQ_NAME_SQL)(_dq(["malformed_name"]))
query("dq_all", SILVER_CTE + DQ_ALL_SQL)(_dq(None))


@query(
    "q_issue_summary",
    SILVER_CTE + f"SELECT issue_type, severity, count(*) AS issue_count FROM ({DQ_ALL_SQL}) i "
    "GROUP BY issue_type, severity ORDER BY issue_count DESC, issue_type, severity",
)
def q_issue_summary(spark, sf_dir):
    return (
        quality.issues(crop_silver(spark, sf_dir, dealt=True))
        .groupBy("issue_type", "severity")
        .agg(F.count(F.lit(1)).alias("issue_count"))
        .orderBy(F.desc("issue_count"), "issue_type", "severity")
    )


@query(
    "validation_run_summary",
    SILVER_CTE + f"SELECT (SELECT count(*) FROM s) AS total_records, "
    f"(SELECT count(*) FROM ({DQ_ALL_SQL}) i) AS issues_found, 'completed' AS status, true AS in_order",
)
def validation_run_summary(spark, sf_dir):
    r = quality.validation_run_summary(crop_silver(spark, sf_dir))
    return r.select("total_records", "issues_found", "status", (F.col("started_at") <= F.col("completed_at")).alias("in_order"))
