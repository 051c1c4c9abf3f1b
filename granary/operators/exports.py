"""Export-side row selection: incremental/equality filters and previews."""

from __future__ import annotations

import datetime as _dt
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def export_filter(df: DataFrame, since: str | _dt.datetime | None = None, where: dict[str, Any] | None = None,
                  ts_col: str = "ingested_at") -> DataFrame:
    """``ts_col >= since`` and every ``column = str(value)``.

    Comparison is on the column's text, as the export's string-built SQL did;
    a NULL never matches. Column names are expressions, not SQL text, so any
    name (mixed case, spaces) works and nothing can be injected (trap T15).
    The predicates reach the Parquet scan as pushed filters where the column
    types allow it.
    """
    out = df
    if since is not None:
        s = since.isoformat(sep=" ") if isinstance(since, _dt.datetime) else str(since)
        out = out.where(F.col(f"`{ts_col}`") >= F.lit(s).cast(df.schema[ts_col].dataType))
    for col, val in (where or {}).items():
        dtype = df.schema[col].dataType.simpleString()
        if dtype == "string":
            out = out.where(F.col(f"`{col}`") == F.lit(str(val)))
        else:
            out = out.where(F.col(f"`{col}`").cast("string") == F.lit(str(val)))
    return out


def preview(df: DataFrame, n: int = 5, n_cols: int | None = None, order_by: list[str] | None = None) -> DataFrame:
    """First ``n`` rows (in a total order when given) and ``n_cols`` columns."""
    cols = df.columns[:n_cols] if n_cols else df.columns
    out = df.orderBy(*order_by) if order_by else df
    return out.select(*cols).limit(n)
