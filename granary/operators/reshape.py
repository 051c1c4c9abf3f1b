"""Wide <-> long reshaping of crop exports.

Column names are schema, so everything that depends on them (parsing, the
metric list, grouping columns by crop and season) is decided when the plan
is built, from ``df.columns``. Row data only flows through Spark expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.functions.headers import export_rename, parse_wide_column
from granary.functions.text import crop_label

# Fixed values that must equal the reference's behaviour: identifier columns
# of the raw export, in the order exports put them first.
EXPORT_ID_COLUMNS = [
    "id", "State", "District", "Year", "source_record_hash", "source_dataset",
    "source_resource_id", "source_system", "ingested_at",
]


def export_reorder(df: DataFrame, preferred: list[str] | None = None) -> DataFrame:
    """Identifier columns first (those present), the rest sorted by name."""
    preferred = preferred or EXPORT_ID_COLUMNS
    first = [c for c in preferred if c in df.columns]
    rest = sorted(c for c in df.columns if c not in first)
    return df.select(*[F.col(f"`{c}`") for c in first + rest])


def renamed_columns(spark: SparkSession, names: list[str]) -> list[str]:
    """``Crop_Season_Metric`` -> ``Crop_Metric_Season`` for a list of names: the
    column expression, run over a frame of the names (one row per column)."""
    frame = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "pos int, name string")
    rows = frame.select("pos", export_rename(F.col("name")).alias("name")).collect()
    return [r["name"] for r in sorted(rows)]


def export_rename_columns(spark: SparkSession, df: DataFrame) -> DataFrame:
    """Apply :func:`export_rename` to every column name (after reordering)."""
    return df.toDF(*renamed_columns(spark, df.columns))


def column_meta(spark: SparkSession, names: list[str], parser=parse_wide_column) -> DataFrame:
    """(original_col, pos, Crop, Metric, Season) for value-column names."""
    meta = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "original_col string, pos int")
    return meta.select("original_col", "pos", parser(F.col("original_col")).alias("p")).select(
        "original_col", "pos", "p.Crop", "p.Metric", "p.Season"
    )


def value_columns(df: DataFrame, ids: list[str]) -> list[str]:
    return [c for c in df.columns if c not in ids]


def wide_to_long(df: DataFrame, ids: list[str], values: list[str] | None = None,
                 var: str = "original_col", value: str = "Value") -> DataFrame:
    """Melt value columns into (var, value) rows; NULL values are kept."""
    values = values if values is not None else value_columns(df, ids)
    cast = df.select(*[F.col(f"`{c}`") for c in ids], *[F.col(f"`{c}`").cast("double").alias(c) for c in values])
    return cast.unpivot(ids, values, var, value)


def melt_meta_join(long: DataFrame, meta: DataFrame, on: str = "original_col") -> DataFrame:
    """Left join of long rows with the per-column metadata.

    The metadata has one row per value column, so the planner broadcasts it
    as long as the schema is of an ordinary width.
    """
    return long.join(meta, on, "left")


def metric_names(meta: DataFrame) -> list[str]:
    """The metrics that the columns' names hold, from a pass over the column catalogue."""
    rows = meta.where(F.col("Metric") != "Unknown").select("Metric").distinct().collect()
    return sorted(r["Metric"] for r in rows)


def pivot_metrics(long_meta: DataFrame, keys: list[str], metrics: list[str]) -> DataFrame:
    """(keys, Crop, Season) x Metric -> first non-NULL value. ``metrics`` comes
    from :func:`metric_names`, so no metric is left out.

    "First" follows the export's column order (``pos``), as the pandas pivot
    with ``aggfunc='first'`` does over melted rows, so ``min_by(Value, pos)``
    over non-NULL values is used. Rows whose key has a NULL are dropped, and
    unparsed names (Metric 'Unknown') are ignored.
    """
    grp = keys + ["Crop", "Season"]
    x = long_meta.where(F.col("Value").isNotNull() & (F.col("Metric") != "Unknown"))
    for k in grp:
        x = x.where(F.col(f"`{k}`").isNotNull())
    return x.groupBy(*grp).pivot("Metric", metrics).agg(F.min_by("Value", "pos"))


def drop_all_null(df: DataFrame, metrics: list[str]) -> DataFrame:
    """Drop rows where every metric is NULL."""
    return df.dropna(how="all", subset=metrics)


def tidy_groups(meta_rows: list) -> tuple[list[tuple[str, str]], list[str], dict]:
    """Group parsed column metadata by (Crop, Season) in column order."""
    groups: dict[tuple[str, str], dict[str, list[str]]] = {}
    metrics: set[str] = set()
    for r in sorted(meta_rows, key=lambda r: r["pos"]):
        if r["Metric"] == "Unknown":
            continue
        metrics.add(r["Metric"])
        groups.setdefault((r["Crop"], r["Season"]), {}).setdefault(r["Metric"], []).append(r["original_col"])
    return list(groups), sorted(metrics), groups


def wide_to_tidy(spark: SparkSession, df: DataFrame, ids: list[str] | None = None,
                 parser=parse_wide_column, label: bool = True) -> DataFrame:
    """Wide crop export -> one row per (ids, Crop, Season) with one column
    per metric.

    Same result as melt -> join names -> pivot(first) -> drop all-NULL, but
    built as a single narrow projection: the (Crop, Season) groups and their
    columns are known from the schema, so each input row emits one struct per
    group (first non-NULL metric value = ``coalesce`` in column order). No
    shuffle; assumes the identifier columns identify a row (true for exports,
    whose ``id`` is the table key).
    """
    ids = [c for c in (ids or EXPORT_ID_COLUMNS) if c in df.columns]
    names = value_columns(df, ids)
    meta = column_meta(spark, names, parser).collect()  # one row per column
    keys, metrics, groups = tidy_groups(meta)

    def metric_value(cols: list[str]) -> Column:
        vals = [F.col(f"`{c}`").cast("double") for c in cols]
        return vals[0] if len(vals) == 1 else F.coalesce(*vals)

    structs = [
        F.struct(
            F.lit(crop).alias("Crop"), F.lit(season).alias("Season"),
            *[(metric_value(groups[(crop, season)][m]) if m in groups[(crop, season)]
               else F.lit(None).cast("double")).alias(m) for m in metrics],
        )
        for crop, season in keys
    ]
    out = df
    for k in ids:
        out = out.where(F.col(f"`{k}`").isNotNull())
    out = out.select(*[F.col(f"`{c}`") for c in ids], F.explode(F.array(*structs)).alias("t"))
    out = out.select(*ids, "t.*")
    out = drop_all_null(out, metrics)
    if label:
        out = out.withColumn("Crop", crop_label(F.col("Crop")))
    return out
