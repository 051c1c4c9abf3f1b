"""Row-level data-quality rules: each row yields 0..n issue rows in one scan."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.numeric import py_float_text
from granary.functions.text import py_strip

# Fixed values that must equal the reference's behaviour.
NULL_CHECK_COLUMNS = ["state_name", "district_name", "crop_name", "year"]
NEGATIVE_CHECK_COLUMNS = ["area_hectare", "production_tonnes", "yield_ton_per_hectare"]
NAME_CHECK_COLUMNS = ["state_name", "district_name"]
YEAR_PATTERN = r"(?U)^\d{4}(-\d{2,4})?$"  # e.g. "2020" or "2020-21"
DIGIT_PATTERN = r"(?U)\d"

RULES = ["null", "negative", "year", "malformed_name"]


@dataclass(frozen=True)
class Check:
    """One rule on one column: a row breaks it where ``broken``; ``number`` or ``text`` is what the detail quotes."""

    broken: Column
    field: str
    issue_type: str
    severity: str
    number: Column | None = None
    text: Column | None = None


def null_checks() -> list[Check]:
    return [Check(F.col(c).isNull(), c, "null_value", "warning") for c in NULL_CHECK_COLUMNS]


def negative_checks() -> list[Check]:
    return [Check(F.col(c) < 0, c, "negative_value", "error", number=F.col(c)) for c in NEGATIVE_CHECK_COLUMNS]


def year_checks() -> list[Check]:
    year = F.col("year")
    return [Check(~py_strip(year).rlike(YEAR_PATTERN), "year", "invalid_year", "warning", text=year)]


def malformed_name_checks() -> list[Check]:
    return [Check(F.col(c).rlike(DIGIT_PATTERN), c, "malformed_name", "info", text=F.col(c)) for c in NAME_CHECK_COLUMNS]


_CHECKS = {"null": null_checks, "negative": negative_checks, "year": year_checks, "malformed_name": malformed_name_checks}


def checks(rules: list[str] | None = None) -> list[Check]:
    return [c for r in rules or RULES for c in _CHECKS[r]()]


def _detail(issue: str) -> Column:
    """What an issue says, from the value it quotes."""
    i = F.col(issue)
    kind, field, text = i["issue_type"], i["field_name"], i["text"]
    return (
        F.when(kind == "null_value", F.concat(field, F.lit(" is null")))
        .when(kind == "negative_value", F.concat(field, F.lit(" = "), py_float_text(i["number"])))
        .when(kind == "invalid_year", F.concat(field, F.lit(" = '"), text, F.lit("'")))
        .otherwise(F.concat(field, F.lit(" = '"), text, F.lit("' contains digits")))
    )


def issues(silver: DataFrame, rules: list[str] | None = None, hash_col: str = "source_record_hash") -> DataFrame:
    """All selected rules over all rows; issues of a row keep rule order.

    Narrow transformations only (no shuffle). Rows that break no rule go
    first, before anything that only issues need (the record hash, the quoted
    numbers) is worked out; the detail text is written once per issue, after
    the explode.
    """
    chosen = checks(rules)
    some = reduce(or_, [F.coalesce(c.broken, F.lit(False)) for c in chosen])
    found = [
        F.when(c.broken, F.struct(
            F.lit(c.field).alias("field_name"), F.lit(c.issue_type).alias("issue_type"), F.lit(c.severity).alias("severity"),
            (F.lit(None).cast("double") if c.number is None else c.number).alias("number"),
            (F.lit(None).cast("string") if c.text is None else c.text).alias("text")))
        for c in chosen
    ]
    rows = silver.where(some).select(F.col(hash_col).alias("record_hash"), F.explode(F.array_compact(F.array(*found))).alias("i"))
    return rows.select("record_hash", "i.field_name", "i.issue_type", _detail("i").alias("issue_detail"), "i.severity")


def issue_count(rules: list[str] | None = None) -> Column:
    """Number of issues of the row: the rule conditions added up (no issue
    structs are built)."""
    return reduce(add, [F.coalesce(c.broken, F.lit(False)).cast("int") for c in checks(rules)])


def validation_run_summary(silver: DataFrame, rules: list[str] | None = None, started_at: Column | None = None) -> DataFrame:
    """One row: when the run started and ended, records checked, issues found, final status; a single scan
    with partial aggregation (no join between the record and issue sides)."""
    return silver.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.coalesce(F.sum(issue_count(rules)), F.lit(0)).cast("bigint").alias("issues_found"),
    ).select(
        (F.lit(dt.datetime.now(dt.timezone.utc)) if started_at is None else started_at).cast("timestamp").alias("started_at"),
        F.current_timestamp().alias("completed_at"),  # when the query that scans the rows runs
        "total_records", "issues_found", F.lit("completed").alias("status"))
