"""Page envelopes -> records, fields, totals; error routing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.text import error_truncate
from granary.schemas import ENVELOPE


def parse_envelope(pages: DataFrame, json_col: str = "raw_json") -> DataFrame:
    """Parse the landed JSON once into an ``env`` struct (PERMISSIVE: a
    malformed page yields a NULL struct, never a failed job)."""
    return pages.withColumn("env", F.from_json(F.col(json_col), ENVELOPE, {"mode": "PERMISSIVE"}))


def _ensure_env(pages: DataFrame) -> DataFrame:
    return pages if "env" in pages.columns else parse_envelope(pages)


def explode_records(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per record: ``keep`` page columns + ``record_no`` + ``record``.
    A page without ``records`` yields no rows."""
    keep = keep if keep is not None else [c for c in pages.columns if c not in ("raw_json", "env")]
    p = _ensure_env(pages)
    return p.select(*keep, F.posexplode(F.col("env.records")).alias("record_no", "record"))


def explode_fields(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """One row per declared field: ``keep`` + field id/name/type."""
    keep = keep if keep is not None else [c for c in pages.columns if c not in ("raw_json", "env")]
    p = _ensure_env(pages)
    return p.select(*keep, F.explode(F.col("env.field")).alias("f")).select(
        *keep,
        F.col("f.id").alias("field_id"),
        F.col("f.name").alias("field_name"),
        F.col("f.type").alias("field_type"),
    )


def page_total(env: Column) -> Column:
    """``int(total)``, 0 when missing or unparsable."""
    return F.coalesce(env.getField("total").try_cast("bigint"), F.lit(0).cast("bigint"))


def is_error_page(raw_json: Column, env: Column | None = None) -> Column:
    """A page is an error when ``status != 'ok'`` (or missing) and the key
    ``error`` exists.

    Evaluated on the raw text with ``get_json_object`` / ``json_object_keys``,
    which only tokenise the envelope: routing pages never builds their record
    maps, so the full parse happens once, for the pages that are kept.
    """
    status = F.get_json_object(raw_json, "$.status")
    has_error = F.array_contains(F.json_object_keys(raw_json), "error")
    # a NULL (missing) status fails the test and falls through, like != 'ok'
    return F.when(status == "ok", F.lit(False)).otherwise(F.coalesce(has_error, F.lit(False)))


def is_empty_html(html: Column) -> Column:
    """An HTML answer holds no data when it says "No Data Found" or has no table."""
    return html.contains("No Data Found") | ~html.contains("table")


def page_reason(raw: Column) -> Column:
    """Why a page is set aside, else NULL: ``malformed`` (neither a JSON object
    nor an HTML page; also a cut-off one or NULL), ``error`` (the envelope says
    so), ``empty`` (an HTML answer without data)."""
    is_html = F.coalesce(F.lower(F.ltrim(raw)).startswith("<"), F.lit(False))
    keys = F.json_object_keys(raw)
    return (
        F.when(is_html, F.when(is_empty_html(raw), F.lit("empty")))
        .when(keys.isNull(), F.lit("malformed"))
        .when(is_error_page(raw), F.lit("error"))
    )


def records_reason(raw: Column, parsed: Column) -> Column:
    """``records`` if the envelope has a member of that name which is no list of objects (also NULL), else
    NULL; ``parsed`` is what :func:`parse_envelope` made of it. Without the member a page has no records."""
    return F.when(parsed.isNull() & F.array_contains(F.json_object_keys(raw), "records"), F.lit("records"))


def split_error_pages(pages: DataFrame, json_col: str = "raw_json") -> tuple[DataFrame, DataFrame]:
    """Route pages to (good, quarantine); quarantined pages have a ``reason``.
    The rule reads the raw text only, but for ``records`` of the wrong type,
    which the parsed envelope shows."""
    marked = parse_envelope(pages.withColumn("reason", page_reason(F.col(json_col))), json_col)
    marked = marked.withColumn("reason", F.coalesce("reason", records_reason(F.col(json_col), F.col("env.records"))))
    good = marked.where(F.col("reason").isNull()).drop("reason")
    bad = marked.where(F.col("reason").isNotNull())
    return good, bad


def failed_jobs(quarantine: DataFrame, json_col: str = "raw_json") -> DataFrame:
    """Quarantined pages as job rows: what failed, and its error text."""
    said = F.coalesce(F.get_json_object(F.col(json_col), "$.error"), F.lit(""))
    text = F.when(F.col("reason") == "error", said).otherwise(F.concat(F.col("reason"), F.lit(" page")))
    return quarantine.select("run_id", F.col("offset").alias("offset_value"), "attempt", "reason",
                             F.lit("failed").alias("status"), error_truncate(text).alias("error_message"))
