"""A wide crop export derived from the driver tables, one row per customer.

id = c_custkey, State = customer region, District = customer nation,
Year = year of the customer's first order. Value columns are named as the
raw export names them, ``{Crop}_{Season}_{Metric}``, with crop = p_type
(``Economy_Grade`` ...), season from l_returnflag, metrics
Area_Hectare = sum(l_quantity), Production_Tonnes = sum(l_extendedprice),
Yield_Tonne_Hectare = their ratio. Extra columns: ``{Crop}_Production_Tonnes``
(shipped lines only, no season -> Whole_Year fallback, collides with the
Whole_Year column) and ``Total_Area`` (matches no pattern, ignored).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from granary.plans.tables import load

# Part types of the export's columns, which the oracle names too. ``wide_export`` makes sure that
# the table has no other (``check_part_types``).
PART_TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]
FLAG_SEASON = [("A", "Kharif"), ("N", "Rabi"), ("R", "Whole_Year")]
METRICS = ["Area_Hectare", "Production_Tonnes", "Yield_Tonne_Hectare"]
IDS = ["id", "State", "District", "Year", "source_system"]


def crop_of(ptype: str) -> str:
    return ptype.capitalize() + "_Grade"


def columns() -> list[tuple[str, str, str, str]]:
    """(export name, crop, season, metric) in the table's own column order."""
    out = []
    for t in PART_TYPES:
        for _flag, season in FLAG_SEASON:
            for m in METRICS:
                out.append((f"{crop_of(t)}_{season}_{m}", crop_of(t), season, m))
    for t in PART_TYPES:
        out.append((f"{crop_of(t)}_Production_Tonnes", crop_of(t), "Whole_Year", "Production_Tonnes"))
    out.append(("Total_Area", None, None, None))
    return out


def check_part_types(part: DataFrame) -> None:
    """Fail on a part type that has no column, rather than lose its rows."""
    other = part.where(F.col("p_type").isNotNull() & ~F.col("p_type").isin(PART_TYPES)).select("p_type").distinct().limit(5)
    names = [r["p_type"] for r in other.collect()]
    if names:
        raise ValueError(f"part types without a column: {names}")


def wide_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = load(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_returnflag", "l_linestatus",
                                                "l_quantity", "l_extendedprice")
    orders = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    part = load(spark, sf_dir, "part").select("p_partkey", "p_type")
    check_part_types(part)
    lp = li.join(orders, li.l_orderkey == orders.o_orderkey).join(part, li.l_partkey == part.p_partkey)
    qty = F.col("l_quantity").cast("decimal(18,2)")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    aggs = [F.min("o_orderdate").alias("first_date")]
    for t in PART_TYPES:
        for flag, season in FLAG_SEASON:
            cond = (F.col("p_type") == t) & (F.col("l_returnflag") == flag)
            base = f"{crop_of(t)}_{season}"
            aggs.append(F.sum(F.when(cond, qty)).cast("double").alias(f"{base}_Area_Hectare"))
            aggs.append(F.sum(F.when(cond, price)).cast("double").alias(f"{base}_Production_Tonnes"))
    for t in PART_TYPES:
        cond = (F.col("p_type") == t) & (F.col("l_linestatus") == "F")
        aggs.append(F.sum(F.when(cond, price)).cast("double").alias(f"{crop_of(t)}_Production_Tonnes"))
    aggs.append(F.sum(qty).cast("double").alias("Total_Area"))
    # lines are dealt by customer first: sums before the shuffle would hold all the columns of every customer of a split
    per_cust = lp.where(F.col("o_custkey").isNotNull()).repartition("o_custkey").groupBy("o_custkey").agg(*aggs)

    cust = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nation = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = load(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = (per_cust.join(cust, per_cust.o_custkey == cust.c_custkey)
         .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
         .join(region, F.col("n_regionkey") == F.col("r_regionkey")))
    sel = [
        F.col("c_custkey").alias("id"), F.col("r_name").alias("State"), F.col("n_name").alias("District"),
        F.year("first_date").cast("string").alias("Year"), F.lit("tables").alias("source_system"),
    ]
    for name, crop, season, metric in columns():
        if metric == "Yield_Tonne_Hectare":
            b = f"{crop}_{season}"
            sel.append((F.col(f"{b}_Production_Tonnes") / F.col(f"{b}_Area_Hectare")).alias(name))
        else:
            sel.append(F.col(name))
    return j.select(*sel)


def wide_sql() -> str:
    """The same table in DuckDB SQL."""
    aggs = ["min(o_orderdate) AS first_date"]
    for t in PART_TYPES:
        for flag, season in FLAG_SEASON:
            cond = f"p_type = '{t}' AND l_returnflag = '{flag}'"
            base = f"{crop_of(t)}_{season}"
            aggs.append(f'CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) FILTER (WHERE {cond}) AS DOUBLE) AS "{base}_Area_Hectare"')
            aggs.append(f'CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE {cond}) AS DOUBLE) AS "{base}_Production_Tonnes"')
    for t in PART_TYPES:
        cond = f"p_type = '{t}' AND l_linestatus = 'F'"
        aggs.append(f'CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE {cond}) AS DOUBLE) AS "{crop_of(t)}_Production_Tonnes"')
    aggs.append('CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS "Total_Area"')
    sel = []
    for name, crop, season, metric in columns():
        if metric == "Yield_Tonne_Hectare":
            b = f"{crop}_{season}"
            sel.append(f'a."{b}_Production_Tonnes" / a."{b}_Area_Hectare" AS "{name}"')
        else:
            sel.append(f'a."{name}"')
    return f"""SELECT c_custkey AS id, r_name AS "State", n_name AS "District",
  CAST(year(first_date) AS VARCHAR) AS "Year", 'tables' AS source_system, {", ".join(sel)}
FROM (SELECT o_custkey, {", ".join(aggs)}
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
      GROUP BY o_custkey) a
JOIN customer ON a.o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey"""


def renamed(name: str, season: str | None, metric: str | None, crop: str | None) -> str:
    """Export name after the season moves to the end (by construction)."""
    if metric is None or name == f"{crop}_{metric}":
        return name
    return f"{crop}_{metric}_{season}"


def export_order() -> list[tuple[str, str, str, str]]:
    """Columns in export order: ids first, value columns sorted by original name."""
    return sorted(columns(), key=lambda c: c[0])
