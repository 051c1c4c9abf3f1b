"""Column-name expressions: multi-row header flattening and wide-name parsing."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from granary.functions.text import py_strip

# Fixed values that must equal the reference's behaviour.
SEASONS = ["Kharif", "Rabi", "Summer", "Whole_Year", "Winter", "Autumn"]
# Season names recognised when exports move the season to the end:
EXPORT_SEASON_PATTERN = r"^(.*?)_(Kharif|Rabi|Summer|Autumn|Winter|Whole_Year)_(.*)$"
# Broad metric marker of the cleaning notebook:
BROAD_METRIC_PATTERN = r"_(Area|Production|Yield)_"
# Exact metric names of the notebook variants:
EXACT_METRICS = ["Area_Hectare", "Production_Tonnes", "Yield_Tonne_Hectare"]
FALLBACK_SEASON = "Whole_Year"


def flatten_headers(parts: Column) -> Column:
    """Multi-row header parts -> one sanitised column name.

    Drop parts containing "Unnamed", strip the rest, drop consecutive repeats,
    join with '_', map every char outside [a-zA-Z0-9_] to '_', collapse runs of
    '_' and strip '_' at both ends.
    """
    kept = F.transform(F.filter(parts, lambda p: ~p.contains("Unnamed")), lambda p: py_strip(p))
    dedup = F.filter(kept, lambda x, i: (i == 0) | (x != F.element_at(kept, i)))
    joined = F.array_join(dedup, "_")
    safe = F.regexp_replace(F.regexp_replace(joined, "[^a-zA-Z0-9_]", "_"), "_+", "_")
    return F.regexp_replace(safe, "^_+|_+$", "")


def export_rename(name: Column) -> Column:
    """``Crop_Season_Metric`` -> ``Crop_Metric_Season``; other names unchanged."""
    return F.when(
        name.rlike(EXPORT_SEASON_PATTERN),
        F.regexp_replace(name, EXPORT_SEASON_PATTERN, "$1_$3_$2"),
    ).otherwise(name)


def _season_of(rest: Column) -> Column:
    out = F.lit(None).cast("string")
    for s in reversed(SEASONS):
        out = F.when(rest.endswith("_" + s), F.lit(s)).otherwise(out)
    return out


def parse_wide_column(name: Column) -> Column:
    """Broad rule: crop = text before the first ``_(Area|Production|Yield)_``;
    rest = text after that first '_'; season = first of SEASONS that ends
    ``rest`` (else Whole_Year); metric = rest without the season suffix.
    No match -> all three 'Unknown'. Returns struct(Crop, Metric, Season)."""
    pos = F.regexp_instr(name, F.lit(BROAD_METRIC_PATTERN))
    matched = pos > 0
    crop = F.substring(name, F.lit(1), pos - 1)
    rest = F.substring(name, pos + 1, F.lit(1 << 30))
    season = _season_of(rest)
    metric = F.when(season.isNull(), rest).otherwise(
        F.substring(rest, F.lit(1), F.length(rest) - F.length(season) - 1)
    )
    unknown = F.lit("Unknown")
    return F.struct(
        F.when(matched, crop).otherwise(unknown).alias("Crop"),
        F.when(matched, metric).otherwise(unknown).alias("Metric"),
        F.when(matched, F.coalesce(season, F.lit(FALLBACK_SEASON))).otherwise(unknown).alias("Season"),
    )


def parse_wide_column_exact(name: Column, season_fallback: bool = True) -> Column:
    """Exact-metric rule: metric is one of EXACT_METRICS found as
    ``_{metric}_``; crop = text before it, season = text after it. Without a
    trailing season the name is dropped (v1, ``season_fallback=False``) or gets
    Whole_Year when it ends with ``_{metric}`` (v2). Unmatched -> NULLs."""
    alt = "|".join(EXACT_METRICS)
    mid = rf"^(.*?)_({alt})_(.*)$"
    end = rf"^(.*)_({alt})$"
    mid_hit = name.rlike(mid)
    end_hit = name.rlike(end) if season_fallback else F.lit(False)
    crop = F.when(mid_hit, F.regexp_extract(name, mid, 1)).when(end_hit, F.regexp_extract(name, end, 1))
    metric = F.when(mid_hit, F.regexp_extract(name, mid, 2)).when(end_hit, F.regexp_extract(name, end, 2))
    season = F.when(mid_hit, F.regexp_extract(name, mid, 3)).when(end_hit, F.lit(FALLBACK_SEASON))
    return F.struct(crop.alias("Crop"), metric.alias("Metric"), season.alias("Season"))
