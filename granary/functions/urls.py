"""URL and request-provenance expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
# Download suffixes recognised by link discovery (matched on the lower-cased href):
DOWNLOAD_SUFFIXES = [".pdf", ".csv", ".xls", ".xlsx", ".zip"]
# Spreadsheet links are rewritten to their CSV export form:
SHEET_MARKER = "docs.google.com/spreadsheets/d/"
SHEET_EXPORT = "https://docs.google.com/spreadsheets/d/{id}/export?format=csv"
# Request parameter whose value is hidden before storage:
SECRET_PARAM = "api-key"

_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.\-]*:"


def request_url(base: Column | str, offset: Column, limit: Column) -> Column:
    """``{base}?offset={o}&limit={l}`` provenance string."""
    b = F.lit(base) if isinstance(base, str) else base
    return F.concat(b, F.lit("?offset="), offset.cast("string"), F.lit("&limit="), limit.cast("string"))


def redact_params(params: Column, secret: str = SECRET_PARAM) -> Column:
    """Replace the secret parameter's value with ``***``."""
    return F.transform_values(params, lambda k, v: F.when(k == F.lit(secret), F.lit("***")).otherwise(v))


def _remove_dot_segments(path: Column) -> Column:
    """RFC 3986 dot-segment removal on a path, as one array fold."""
    segs = F.split(path, "/")
    folded = F.aggregate(
        segs,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, 1, F.size(acc) - 1)).otherwise(acc))
        .when(s == ".", acc)
        .otherwise(F.array_append(acc, s)),
    )
    trailing = F.when(path.rlike(r"(^|/)\.\.?$"), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(folded, "/"), trailing)


def url_join(base: Column, href: Column) -> Column:
    """Resolve ``href`` against ``base`` (``urllib.parse.urljoin`` rules for
    absolute, scheme-relative, root-relative, query, fragment and relative
    references, with dot segments removed)."""
    scheme = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*):", 1)
    origin = F.regexp_extract(base, r"^([a-zA-Z][a-zA-Z0-9+.\-]*://[^/?#]*)", 1)
    no_frag = F.regexp_replace(base, "#.*$", "")
    no_query = F.regexp_replace(no_frag, r"\?.*$", "")
    base_path = F.substring(no_query, F.length(origin) + 1, 1 << 30)
    base_dir = F.regexp_extract(base_path, r"^(.*/)", 1)
    rel_path = F.when(base_dir == "", F.concat(F.lit("/"), href)).otherwise(F.concat(base_dir, href))
    resolved_rel = F.concat(origin, F.when(rel_path.contains("/."), _remove_dot_segments(rel_path)).otherwise(rel_path))
    root_rel = F.concat(origin, F.when(href.contains("/."), _remove_dot_segments(href)).otherwise(href))
    return (
        F.when(href == "", no_frag)
        .when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), root_rel)
        .when(href.startswith("?"), F.concat(no_query, href))
        .when(href.startswith("#"), F.concat(no_frag, href))
        .otherwise(resolved_rel)
    )


def has_download_suffix(href: Column, suffixes: list[str] | None = None) -> Column:
    low = F.lower(href)
    cond = F.lit(False)
    for s in suffixes if suffixes is not None else DOWNLOAD_SUFFIXES:
        cond = cond | low.endswith(s)
    return cond


def sheet_export_url(href: Column) -> Column:
    """Spreadsheet link -> CSV-export URL (id = text after '/d/' up to '/')."""
    file_id = F.regexp_extract(href, "/d/([^/]*)", 1)
    pre, post = SHEET_EXPORT.split("{id}")
    return F.concat(F.lit(pre), file_id, F.lit(post))


def manifest_filename(url: Column) -> Column:
    """Local file name for a download URL.

    Spreadsheet export -> ``<id>.csv``; else the last path segment without its
    query; empty -> ``download_`` + first 8 hex of md5(url).
    """
    is_export = url.contains("docs.google.com") & url.contains("export?format=csv")
    export_name = F.concat(F.regexp_extract(url, "/d/([^/]*)", 1), F.lit(".csv"))
    last = F.element_at(F.split(url, "/"), -1)
    no_query = F.element_at(F.split(last, r"\?"), 1)
    fallback = F.concat(F.lit("download_"), F.substring(F.md5(url), 1, 8))
    plain = F.when(no_query == "", fallback).otherwise(no_query)
    return F.when(is_export, export_name).otherwise(plain)
