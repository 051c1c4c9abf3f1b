"""Reshape keys over the wide crop export (see plans/wide.py). Oracle SQL is
generated from how the table is built, not by parsing its names."""

from __future__ import annotations

from pyspark.sql import functions as F

from granary.functions.headers import parse_wide_column, parse_wide_column_exact
from granary.functions.text import crop_label
from granary.operators import reshape
from granary.plans import wide
from granary.plans.registry import query
from granary.plans.tables import load

W = f"WITH w AS ({wide.wide_sql()})\n"
_IDS_SQL = 'id, "State", "District", "Year", source_system'


def _export(spark, sf_dir):
    """Raw export -> reordered -> season moved to the end."""
    e = reshape.export_reorder(wide.wide_export(spark, sf_dir))
    return reshape.export_rename_columns(spark, e)


@query("export_reorder", W + "SELECT * FROM w")
def export_reorder(spark, sf_dir):
    return reshape.export_reorder(wide.wide_export(spark, sf_dir))


@query(
    "export_rename",
    W + f"SELECT {_IDS_SQL}, "
    + ", ".join(f'"{n}" AS "{wide.renamed(n, s, m, c)}"' for n, c, s, m in wide.columns())
    + " FROM w",
)
def export_rename(spark, sf_dir):
    return _export(spark, sf_dir)


def _meta_values(rule: str) -> str:
    rows = []
    for n, c, s, m in wide.export_order():
        new = wide.renamed(n, s, m, c)
        if rule == "broad":
            vals = (c, m, s) if m else ("Unknown", "Unknown", "Unknown")
        else:  # exact metric names, season fallback (v2) and v1 season
            if m is None:
                vals = (None, None, None, None)
            elif new == f"{c}_{m}":
                vals = (c, m, "Whole_Year", None)
            else:
                vals = (c, m, s, s)
        rows.append("(" + ", ".join(["'%s'" % new] + ["NULL" if v is None else "'%s'" % v for v in vals]) + ")")
    return ", ".join(rows)


_LONG_SQL = (
    W + f"SELECT * FROM (SELECT {_IDS_SQL}, "
    + ", ".join(f'"{n}" AS "{wide.renamed(n, s, m, c)}"' for n, c, s, m in wide.columns())
    + " FROM w) UNPIVOT INCLUDE NULLS (\"Value\" FOR original_col IN ("
    + ", ".join(f'"{wide.renamed(n, s, m, c)}"' for n, c, s, m in wide.columns())
    + ")) "
)


@query(
    "parse_wide_column",
    f"""SELECT l.id, l.original_col, m."Crop", m."Metric", m."Season"
FROM ({_LONG_SQL}) l JOIN (VALUES {_meta_values('broad')}) m(original_col, "Crop", "Metric", "Season")
  ON l.original_col = m.original_col WHERE l."Value" IS NOT NULL""",
)
def parse_wide_column_q(spark, sf_dir):
    e = _export(spark, sf_dir)
    long = reshape.wide_to_long(e, wide.IDS).where(F.col("Value").isNotNull())
    return long.select("id", "original_col", parse_wide_column(F.col("original_col")).alias("p")).select(
        "id", "original_col", "p.Crop", "p.Metric", "p.Season")


@query(
    "parse_wide_column_exact",
    f"""SELECT l.id, l.original_col, m."Crop", m."Metric", m."Season", m."Season_v1"
FROM ({_LONG_SQL}) l JOIN (VALUES {_meta_values('exact')}) m(original_col, "Crop", "Metric", "Season", "Season_v1")
  ON l.original_col = m.original_col WHERE l."Value" IS NOT NULL""",
)
def parse_wide_column_exact_q(spark, sf_dir):
    e = _export(spark, sf_dir)
    long = reshape.wide_to_long(e, wide.IDS).where(F.col("Value").isNotNull())
    v2 = parse_wide_column_exact(F.col("original_col"), season_fallback=True)
    v1 = parse_wide_column_exact(F.col("original_col"), season_fallback=False)
    return long.select("id", "original_col", v2.alias("p"), v1.getField("Season").alias("Season_v1")).select(
        "id", "original_col", "p.Crop", "p.Metric", "p.Season", "Season_v1")


@query("wide_to_long", _LONG_SQL)
def wide_to_long(spark, sf_dir):
    return reshape.wide_to_long(_export(spark, sf_dir), wide.IDS)


@query(
    "melt_meta_join",
    f"""SELECT l.*, m."Crop", m."Metric", m."Season"
FROM ({_LONG_SQL}) l LEFT JOIN (VALUES {_meta_values('broad')}) m(original_col, "Crop", "Metric", "Season")
  ON l.original_col = m.original_col""",
)
def melt_meta_join(spark, sf_dir):
    e = _export(spark, sf_dir)
    names = reshape.value_columns(e, wide.IDS)
    meta = reshape.column_meta(spark, names).drop("pos")
    return reshape.melt_meta_join(reshape.wide_to_long(e, wide.IDS), meta)


def _tidy_sql(label: bool) -> str:
    parts = []
    for t in wide.PART_TYPES:
        c = wide.crop_of(t)
        for _f, s in wide.FLAG_SEASON:
            a = f'"{c}_{s}_Area_Hectare"'
            p = f'"{c}_{s}_Production_Tonnes"'
            if s == "Whole_Year":
                p = f'coalesce("{c}_Production_Tonnes", {p})'
            y = f'"{c}_{s}_Yield_Tonne_Hectare"'
            crop = f"'{c.replace('_', ' ')}'" if label else f"'{c}'"
            parts.append(f"SELECT {_IDS_SQL}, {crop} AS \"Crop\", '{s}' AS \"Season\", {a} AS \"Area_Hectare\", "
                         f"{p} AS \"Production_Tonnes\", {y} AS \"Yield_Tonne_Hectare\" FROM w")
    return (W + "SELECT * FROM (" + "\nUNION ALL\n".join(parts) + ") t "
            'WHERE "Area_Hectare" IS NOT NULL OR "Production_Tonnes" IS NOT NULL OR "Yield_Tonne_Hectare" IS NOT NULL')


@query("pivot_metrics", _tidy_sql(label=False))
def pivot_metrics(spark, sf_dir):
    e = _export(spark, sf_dir)
    names = reshape.value_columns(e, wide.IDS)
    meta = reshape.column_meta(spark, names)
    lm = reshape.melt_meta_join(reshape.wide_to_long(e, wide.IDS), meta)
    return reshape.pivot_metrics(lm, wide.IDS, reshape.metric_names(meta))


@query("drop_all_null_metrics", _tidy_sql(label=False))
def drop_all_null_metrics(spark, sf_dir):
    return reshape.wide_to_tidy(spark, _export(spark, sf_dir), wide.IDS, label=False)


@query("wide_to_tidy", _tidy_sql(label=True))
def wide_to_tidy(spark, sf_dir):
    return reshape.wide_to_tidy(spark, _export(spark, sf_dir), wide.IDS)


@query("crop_label", "SELECT p_partkey, replace(p_type || '_' || replace(p_name, ' ', '_'), '_', ' ') AS crop FROM part")
def crop_label_q(spark, sf_dir):
    p = load(spark, sf_dir, "part")
    raw = F.concat(F.col("p_type"), F.lit("_"), F.regexp_replace("p_name", " ", "_"))
    return p.select("p_partkey", crop_label(raw).alias("crop"))
