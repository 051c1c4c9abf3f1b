"""District lineage: heterogeneous event layouts -> events -> edges ->
master table, plus matching of edges against a reference directory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from granary.functions.hashing import district_id
from granary.functions.text import blank_to_null, clean_name, decade_start, event_label, py_strip, title_case

# Fixed values that must equal the reference's behaviour.
# Event CSV layouts, checked in this order; the first whose two marker
# columns are all present decides how the file is read.
LAYOUTS = [
    {"name": "new_district", "markers": ["Old districts", "New District"], "parent": "Old districts",
     "child": "New District", "year": "Year", "decade": False, "event_type": "NEW_DISTRICT"},
    {"name": "split", "markers": ["District-Before", "District-After"], "parent": "District-Before",
     "child": "District-After", "year": "Year", "decade": False, "event_type": "SPLIT"},
    {"name": "rename", "markers": ["Old Name", "New Name"], "parent": "Old Name",
     "child": "New Name", "year": "Decade", "decade": True, "event_type": "RENAME"},
]
STATE_COLUMN = "State/UT"
ONE_TO_ONE_TYPES = ["SPLIT", "NEW_DISTRICT", "BOUNDARY_TRANSFER", "RENAME"]
MERGER_TYPE = "MERGER"
KNOWN_EVENT_TYPES = ONE_TO_ONE_TYPES + [MERGER_TYPE]
NO_DIRECTORY_NOTE = "LGD data not available for check."
EXACT_NOTE = "Exact match in reference directory."
FUZZY_NOTE = "Closest reference name within edit distance {d}."
NO_MATCH_NOTE = "No reference name within edit distance {d}."


def layout_of(columns: list[str]) -> dict | None:
    """First layout whose marker columns are all present (trap T7)."""
    cols = set(columns)
    for lay in LAYOUTS:
        if set(lay["markers"]) <= cols:
            return lay
    return None


def alias_table(aliases: DataFrame | dict | None, spark=None) -> DataFrame | None:
    if aliases is None or isinstance(aliases, DataFrame):
        return aliases
    return spark.createDataFrame(sorted(aliases.items()), "alias string, canonical string")


def clean_with_aliases(df: DataFrame, cols: list[str], aliases: DataFrame | None) -> DataFrame:
    """Clean name columns; alias lookup through a (guarded) broadcast join."""
    out = df.withColumns({c: clean_name(F.col(f"`{c}`")) for c in cols})
    if aliases is None:
        return out
    a = unique_aliases(aliases)
    for c in cols:
        m = a.select(F.col("alias").alias(f"_a_{c}"), F.col("canonical").alias(f"_c_{c}"))
        out = (out.join(m, F.col(f"`{c}`") == F.col(f"_a_{c}"), "left")
               .withColumn(c, F.coalesce(F.col(f"_c_{c}"), F.col(f"`{c}`")))
               .drop(f"_a_{c}", f"_c_{c}"))
    return out


def unique_aliases(aliases: DataFrame) -> DataFrame:
    """One canonical name per alias (the smallest when an alias repeats), so
    the lookup join can never multiply rows."""
    return aliases.groupBy("alias").agg(F.min("canonical").alias("canonical"))


def events_from_layout(df: DataFrame, layout: dict, aliases: DataFrame | None = None,
                       file_col: str = "source_document", url_col: str = "source_url") -> DataFrame:
    """One layout's rows -> the 10-column event schema.

    An absent or blank year becomes NULL (trap T6 fix), a decade keeps the
    text before its first '-'.
    """
    cols = set(df.columns)
    state = F.col(f"`{STATE_COLUMN}`") if STATE_COLUMN in cols else F.lit("")
    yr_src = F.col(f"`{layout['year']}`") if layout["year"] in cols else F.lit(None).cast("string")
    year = decade_start(blank_to_null(yr_src)) if layout["decade"] else blank_to_null(yr_src)
    ev = df.select(
        state.cast("string").alias("state"),
        F.col(f"`{layout['parent']}`").cast("string").alias("parent_district"),
        F.col(f"`{layout['child']}`").cast("string").alias("child_district"),
        F.lit(layout["event_type"]).alias("event_type"),
        F.lit(None).cast("date").alias("effective_date"),
        year.alias("effective_year"),
        F.lit(None).cast("date").alias("notification_date"),
        F.col(file_col).alias("source_document") if file_col in cols else F.lit(None).cast("string").alias("source_document"),
        F.col(url_col).alias("source_url") if url_col in cols else F.lit(None).cast("string").alias("source_url"),
        F.lit("").alias("remarks"),
    )
    return clean_with_aliases(ev, ["parent_district", "child_district"], aliases)


def event_union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def merger_parents(parent: Column) -> Column:
    """MERGER parent list: split on ',', each cleaned, empty names dropped
    (trap T20). A NULL parent reads as the text 'None' like ``str(None)``."""
    parts = F.split(F.coalesce(parent, F.lit("None")), ",")
    cleaned = F.transform(parts, lambda p: title_case(py_strip(p)))
    return F.filter(cleaned, lambda p: p != "")


def lineage_edges(events: DataFrame, aliases: DataFrame | None = None, distinct: bool = True) -> DataFrame:
    """Events -> typed, dated edges. One-to-one types pass through, MERGER
    fans out over its parents, unknown types give no edge; exact duplicates
    are dropped (hash aggregate with map-side partial dedup)."""
    et = F.col("event_type")
    sources = (
        F.when(et.isin(ONE_TO_ONE_TYPES), F.array(F.col("parent_district")))
        .when(et == MERGER_TYPE, merger_parents(F.col("parent_district")))
        .otherwise(F.array().cast("array<string>"))
    )
    e = events.select(
        F.explode(sources).alias("source_district"),
        F.col("child_district").alias("target_district"),
        "event_type",
        F.col("effective_year").cast("string").alias("effective_year"),
        "state",
        F.col("source_document").alias("source"),
        (et == MERGER_TYPE).alias("_merger"),
    )
    if aliases is not None:
        # MERGER parents were cleaned above; their alias lookup is one
        # conditional join over all edges (no split-and-union of the input)
        a = unique_aliases(aliases).select(F.col("alias").alias("_alias"),
                                                             F.col("canonical").alias("_canon"))
        e = (e.join(a, F.col("_merger") & (F.col("source_district") == F.col("_alias")), "left")
             .withColumn("source_district", F.coalesce(F.col("_canon"), F.col("source_district")))
             .drop("_alias", "_canon"))
    e = e.drop("_merger")
    return e.dropDuplicates() if distinct else e


def known_event_types(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type").isin(KNOWN_EVENT_TYPES))


def district_master(events: DataFrame) -> DataFrame:
    """One row per event with a deterministic district id."""
    return events.select(
        district_id(F.col("state"), F.col("child_district")).alias("district_id"),
        F.col("child_district").alias("district_name"),
        "state", "parent_district", "child_district", "event_type", "effective_year",
        F.col("source_document").alias("source"),
        F.lit(1.0).alias("confidence_score"),
    )


def _one_deletions(k: Column) -> Column:
    """Every string made by deleting one character of ``k``."""
    return F.transform(
        F.sequence(F.lit(1), F.greatest(F.length(k), F.lit(1))),
        lambda i: F.concat(F.substring(k, F.lit(1), i - 1), F.substring(k, i + 1, F.lit(1 << 30))),
    )


def _deletion_keys(name: Column, depth: int = 1) -> Column:
    """The name and every string made by deleting up to ``depth`` characters.

    Two names within Levenshtein distance ``depth`` always share one of these
    keys (symmetric deletion), so an equi-join on them finds every such pair.
    Names sharing a key number at most |alphabet|^depth x (length + 1)^depth.
    """
    keys = F.array_distinct(F.concat(F.array(name), _one_deletions(name)))
    for _ in range(depth - 1):
        keys = F.array_distinct(F.flatten(F.transform(keys, lambda k: F.concat(F.array(k), _one_deletions(k)))))
    return keys


#: from this distance on candidates come by segments, as deletion keys grow as length^distance
SEGMENTS_FROM = 2
#: a segment that more reference names share is left to the deletion keys of the names that hold it
HOT_SEGMENT = 256


def _segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """(start from 0, width) of the ``i``-th of ``parts`` even segments of a text of ``length``."""
    start, end = (F.floor(length * k / F.lit(parts)).cast("int") for k in (i, i + 1))
    return start, end - start


def _segment_key(length: Column, i: int, text: Column) -> Column:
    return F.struct(length.alias("length"), F.lit(i).alias("i"), text.alias("text"))


def _key_at(name: Column, length: Column, i: int, width: Column):
    return lambda at: _segment_key(length, i, F.substring(name, at + 1, width))


def _segment_keys(name: Column, depth: int) -> Column:
    """(length, place, segment) of the ``depth`` + 1 even segments of a name."""
    n = F.length(name)
    keys = []
    for i in range(depth + 1):
        start, width = _segment(n, i, depth + 1)
        keys.append(_segment_key(n, i, F.substring(name, start + 1, width)))
    return F.array(*keys)


def _probe_keys(name: Column, depth: int) -> Column:
    """The segment keys that a name within ``depth`` of this one can share with it.

    Of ``depth`` + 1 segments one stays whole such that at most i edits lie left
    of the i-th (from 0) and at most ``depth`` - i right of it, which bounds
    where it can start here: (depth^2 - shift^2) / 2 + depth + 1 places for each
    difference in length, whatever the name's length.
    """
    n = F.length(name)
    keys = []
    for shift in range(-depth, depth + 1):
        length = n - shift
        for i in range(depth + 1):
            start, width = _segment(length, i, depth + 1)
            low = F.greatest(F.lit(0), start - i, start + shift - (depth - i))
            high = F.least(n - width, start + i, start + shift + (depth - i))
            found = F.transform(F.sequence(low, high), _key_at(name, length, i, width))
            keys.append(F.when((length >= 0) & (low <= high), found).otherwise(F.slice(found, 1, 0)))
    return F.array_distinct(F.concat(*keys))


def _pairs(names: DataFrame, ref: DataFrame, depth: int) -> DataFrame:
    """(district, ref_name) pairs that share a deletion key (or, which costs a
    comparison, its hash). The planner takes exploded keys for as small as the
    names they come from, so both sides are shuffled by a hint."""
    nk = names.select("district", F.explode(_deletion_keys(F.col("district"), depth)).alias("k"))
    rk = ref.where(F.col("ref_name").isNotNull()).select("ref_name", F.explode(_deletion_keys(F.col("ref_name"), depth)).alias("k"))
    nk, rk = (df.withColumn("k", F.xxhash64("k")) for df in (nk, rk))
    return nk.hint("merge").join(rk, "k").select("district", "ref_name")


def candidates(names: DataFrame, ref: DataFrame, depth: int, segments_from: int = SEGMENTS_FROM,
               hot: int = HOT_SEGMENT) -> DataFrame:
    """Distinct (district, ref_name) pairs among which are all within Levenshtein distance ``depth``.

    Below ``segments_from`` by deletion keys. From there by segments: a
    reference name has ``depth`` + 1 keys, a name some tens. A segment that more
    than ``hot`` reference names share (a common prefix, say) would pair them all
    with each other, so names that hold one are matched by deletion keys, whose
    groups are bounded; a pair that shares hot segments only has one on both sides.
    """
    if depth < segments_from:
        return _pairs(names, ref, depth).distinct()
    nk = names.select("district", F.explode(_probe_keys(F.col("district"), depth)).alias("k"))
    rk = ref.select("ref_name", F.explode(_segment_keys(F.col("ref_name"), depth)).alias("k"))
    often = rk.groupBy("k").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("k")
    common = nk.join(often, "k", "left_anti").hint("merge").join(rk.join(often, "k", "left_anti"), "k").select("district", "ref_name")
    hot_names = nk.join(often, "k", "left_semi").select("district").distinct()
    hot_refs = rk.join(often, "k", "left_semi").select("ref_name").distinct()
    return common.unionByName(_pairs(hot_names, hot_refs, depth)).distinct()


def reference_validate(edges: DataFrame, directory: DataFrame | None, max_distance: int = 1,
                       materialize: bool = True) -> DataFrame:
    """Check every edge's target district against a reference directory.

    Exact name -> match, score 1.0. Otherwise the closest directory name with
    Levenshtein distance <= ``max_distance`` (:func:`candidates` finds every
    such pair by equi-joins and never pairs all names of a block);
    score = 1 - d / longer length. No side is broadcast: names and directory
    grow with the tables, by far more than compressed files tell the planner.
    No directory -> no match, score 0.0.
    """
    if max_distance < 1:
        raise ValueError("max_distance must be at least 1")
    base = edges.select(
        event_label(F.col("event_type"), F.col("effective_year")).alias("event"),
        F.col("target_district").alias("district"),
    )
    if directory is None:
        return base.select(
            "event", "district", F.lit(False).alias("lgd_match"), F.lit(0.0).alias("confidence_score"),
            F.lit(NO_DIRECTORY_NOTE).alias("validation_notes"),
        )
    if materialize:
        # the edge labels feed four branches below; write them once to the
        # shared checkpoint folder instead of re-deriving the edges in each
        from granary.session import shared_dir
        shared_dir(base.sparkSession)
        base = base.checkpoint(eager=True)
    names = base.select("district").distinct().where(F.col("district").isNotNull())
    ref = directory.select(F.col("name").alias("ref_name")).distinct()
    # an exact name (distance 0) cannot be beaten: settle those with an
    # equi-join and send only the rest through the fuzzy path
    shuffled = ref.hint("merge")
    exact = names.join(shuffled, names.district == ref.ref_name, "left_semi")
    rest = names.join(shuffled, names.district == ref.ref_name, "left_anti")
    cand = candidates(rest, ref, max_distance)
    cand = cand.withColumn("d", F.levenshtein("district", "ref_name")).where(F.col("d") <= max_distance)
    fuzzy = cand.groupBy("district").agg(F.min_by(F.struct("d", "ref_name"), F.struct("d", "ref_name")).alias("b"))
    best = exact.select("district", F.struct(F.lit(0).alias("d"), F.col("district").alias("ref_name")).alias("b")) \
        .unionByName(fuzzy)
    j = base.join(best.hint("merge"), "district", "left")
    d = F.col("b.d")
    longest = F.greatest(F.length("district"), F.length(F.col("b.ref_name")))
    return j.select(
        "event", "district",
        d.isNotNull().alias("lgd_match"),
        F.when(d.isNull(), F.lit(0.0)).otherwise(1.0 - d / longest).alias("confidence_score"),
        F.when(d.isNull(), F.lit(NO_MATCH_NOTE.format(d=max_distance)))
        .when(d == 0, F.lit(EXACT_NOTE))
        .otherwise(F.lit(FUZZY_NOTE.format(d=max_distance))).alias("validation_notes"),
    )
