"""String column functions (all JVM-side expressions, no Python UDFs)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour: the characters
# Python's str.strip() removes (str.isspace()), as code points.
PY_WHITESPACE = [
    0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680,
    0x2000, 0x2001, 0x2002, 0x2003, 0x2004, 0x2005, 0x2006, 0x2007, 0x2008, 0x2009, 0x200A,
    0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
]
_WS = "".join(chr(c) for c in PY_WHITESPACE)
# Marker placed after non-letters while title-casing. A marker in the input is a non-letter too, so
# the one put in follows it at once and only that one, with its space, is taken out again.
_MARK = "\u0002"


def py_strip(c: Column) -> Column:
    """Remove leading/trailing whitespace exactly like ``str.strip()``
    (Spark's ``trim`` only removes spaces); ``btrim`` with the character set
    is code-generated and needs no regular expression."""
    return F.btrim(c, F.lit(_WS))


def title_case(c: Column) -> Column:
    """Python ``str.title()``: a letter is upper-cased when it follows a
    non-letter (or starts the string), every other letter is lower-cased.

    Spark's ``initcap`` only restarts after a space (``O'brien``). So a
    marker and a space are inserted after every non-letter, ``initcap`` runs,
    and the inserted pairs are removed again - all codegen'd string
    functions, no per-row lambda.
    """
    marked = F.regexp_replace(F.lower(c), r"(\P{L})", "$1" + _MARK + " ")
    return F.replace(F.initcap(marked), F.lit(_MARK + " "), F.lit(""))


def lookup(c: Column, mapping: dict[str, str]) -> Column:
    """``mapping.get(c, c)`` for a small literal mapping."""
    if not mapping:
        return c
    m = F.create_map(*[F.lit(x) for kv in sorted(mapping.items()) for x in kv])
    return F.coalesce(F.try_element_at(m, c), c)


def clean_name(c: Column, aliases: dict[str, str] | None = None) -> Column:
    """District name standardisation: NULL/empty -> '', strip, title case,
    then alias lookup (aliases are keyed by the title-cased name)."""
    base = title_case(py_strip(c.cast("string")))
    out = lookup(base, aliases or {})
    return F.when(c.isNull() | (c.cast("string") == ""), F.lit("")).otherwise(out)


def crop_label(c: Column) -> Column:
    """Crop label: underscores become spaces."""
    return F.translate(c, "_", " ")


def error_truncate(c: Column, n: int = 2000) -> Column:
    """First ``n`` characters of an error message."""
    return F.left(c, F.lit(n))


def decade_start(c: Column) -> Column:
    """Text before the first '-', else the whole value."""
    s = c.cast("string")
    return F.substring_index(s, "-", 1)


def event_label(event_type: Column, year: Column) -> Column:
    """"{type} {year}" as the validation report prints it."""
    return F.concat(
        F.coalesce(event_type.cast("string"), F.lit("None")),
        F.lit(" "),
        F.coalesce(year.cast("string"), F.lit("None")),
    )


def blank_to_null(c: Column) -> Column:
    """'' and the text 'nan' become NULL (missing-year fix, trap T6)."""
    s = c.cast("string")
    return F.when(s.isNull() | (py_strip(s) == "") | (F.lower(py_strip(s)) == "nan"), None).otherwise(s)
