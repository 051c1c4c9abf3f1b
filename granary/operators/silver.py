"""Bronze -> silver standardisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.numeric import number_of, safe_float
from granary.functions.text import py_strip

# Fixed values that must equal the reference's behaviour:
# lower-cased source field id -> silver column.
SILVER_FIELD_MAP = {
    "state_name": "state_name",
    "state__name": "state_name",
    "district_name": "district_name",
    "district__name": "district_name",
    "crop": "crop_name",
    "crop_name": "crop_name",
    "season": "season",
    "crop_year": "year",
    "year": "year",
    "area_": "area_hectare",
    "area": "area_hectare",
    "area__in_hectare_": "area_hectare",
    "production_": "production_tonnes",
    "production": "production_tonnes",
    "production__in_tonnes_": "production_tonnes",
    "yield": "yield_ton_per_hectare",
    "yield_": "yield_ton_per_hectare",
    "yield__tonnes_hectare_": "yield_ton_per_hectare",
}

SILVER_TEXT = ["state_name", "district_name", "crop_name", "season", "year"]
SILVER_MEASURES = ["area_hectare", "production_tonnes", "yield_ton_per_hectare"]


def _sources_of(target: str) -> list[str]:
    return [k for k, v in SILVER_FIELD_MAP.items() if v == target]


def silver_select(rows: DataFrame, fields: list[str], keep: list[str] | None = None) -> DataFrame:
    """The silver columns of rows whose fields are columns of their own, in record order.

    The same rule as :func:`silver_map` (of several fields for one target the
    last wins, also when NULL), decided from the names when the plan is
    built. So only the fields in use are read; a silver column that a query
    leaves out isn't worked out.
    """
    last = {SILVER_FIELD_MAP[f.lower()]: f for f in fields if f.lower() in SILVER_FIELD_MAP}

    def value(target: str) -> Column:
        if target not in last:
            return F.lit(None).cast("double" if target in SILVER_MEASURES else "string")
        c = F.col(f"`{last[target]}`")
        return safe_float(c) if target in SILVER_MEASURES else py_strip(c)

    keep = keep if keep is not None else ["source_record_hash"]
    return rows.select(*[value(t).alias(t) for t in SILVER_TEXT + SILVER_MEASURES], *keep)


def lowered_keys_reversed(record: Column) -> Column:
    """Lower-cased record keys, last key first."""
    return F.reverse(F.transform(F.map_keys(record), F.lower))


def silver_value(record: Column, target: str, rev_keys: Column | None = None) -> Column:
    """Value of one silver column from a record map (single-column form).

    When several source keys map to ``target`` the last one in record order
    wins, even when its value is NULL. Measures go through ``safe_float``,
    text is stripped. :func:`silver_map` computes the same thing in stages.
    """
    rev = rev_keys if rev_keys is not None else lowered_keys_reversed(record)
    nearest = _nearest(rev, target)
    raw = F.element_at(F.map_values(record), (F.size(F.map_keys(record)) + 1 - nearest).cast("int"))
    if target in SILVER_MEASURES:
        return safe_float(raw)
    return py_strip(raw)


def _nearest(rev: Column, target: str) -> Column:
    """Distance from the end of the last key matching one of ``target``'s
    source names (NULL when none matches)."""
    found = [F.nullif(F.array_position(rev, F.lit(a)), F.lit(0)) for a in _sources_of(target)]
    return found[0] if len(found) == 1 else F.least(*found)


def silver_map(records: DataFrame, record_col: str = "record", keep: list[str] | None = None) -> DataFrame:
    """Map each record to the eight silver columns (+ ``keep`` columns).

    Built as a chain of narrow projections in which every intermediate
    (reversed keys, match positions, raw text, cleaned text) is its own
    column. An expression used twice is thus computed once, and the
    generated code grows linearly with the number of columns instead of
    duplicating subtrees (which made the fused stage too large to JIT).
    """
    keep = keep if keep is not None else ["source_record_hash"]
    targets = SILVER_TEXT + SILVER_MEASURES
    rec = F.col(record_col)
    s1 = records.select(rec.alias("_rec"), lowered_keys_reversed(rec).alias("_rev"),
                        F.size(F.map_keys(rec)).alias("_n"), *keep)
    s2 = s1.select("_rec", "_n", *[_nearest(F.col("_rev"), t).alias(f"_p_{t}") for t in targets], *keep)
    s3 = s2.select(
        *[F.element_at(F.map_values("_rec"), (F.col("_n") + 1 - F.col(f"_p_{t}")).cast("int")).alias(f"_r_{t}")
          for t in targets],
        *keep,
    )
    s4 = s3.select(
        *[py_strip(F.col(f"_r_{t}")).alias(t) for t in SILVER_TEXT],
        *[F.replace(py_strip(F.col(f"_r_{t}")), F.lit(","), F.lit("")).alias(f"_t_{t}") for t in SILVER_MEASURES],
        *keep,
    )
    return s4.select(
        *SILVER_TEXT,
        *[number_of(F.col(f"_t_{t}")).alias(t) for t in SILVER_MEASURES],
        *keep,
    )
