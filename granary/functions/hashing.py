"""Fingerprints: record hash and deterministic ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_map(m: Column) -> Column:
    """The same map with its entries in key order."""
    return F.map_from_entries(F.sort_array(F.map_entries(m)))


def canonical_json(m: Column) -> Column:
    """Canonical text of a ``map<string,string>`` record: keys sorted, compact
    separators, NULL values kept as ``null``.

    Own definition (trap T1): UTF-8 is written as is, not ``\\uXXXX``-escaped.
    """
    return F.to_json(sorted_map(m))


def record_hash(m: Column) -> Column:
    """SHA-256 hex of the canonical JSON of a stringified record map."""
    return F.sha2(canonical_json(m), 256)


def ascii_json(text: Column) -> Column:
    """JSON text with every character from U+0080 on as lower-case ``\\uXXXX`` (two of them beyond
    U+FFFF), the way Python's ``json.dumps`` prints it by default."""

    def code(n: Column) -> Column:
        return F.concat(F.lit("\\u"), F.lower(F.lpad(F.hex(n), 4, "0")))

    def one(c: Column) -> Column:
        n = F.ascii(c)
        pair = F.concat(code(F.lit(0xD800) + F.shiftright(n - 0x10000, 10)), code(F.lit(0xDC00) + (n - 0x10000) % 1024))
        return F.when(n < 128, c).when(n < 0x10000, code(n)).otherwise(pair)

    return F.when(text.rlike(r"[^\x00-\x7F]"), F.array_join(F.transform(F.split(text, ""), one), "")).otherwise(text)


def record_hash_compat(m: Column) -> Column:
    """The fingerprint of a text record as other tools compute it from
    ``json.dumps(record, sort_keys=True, separators=(",", ":"))``."""
    return F.sha2(ascii_json(canonical_json(m)), 256)


def struct_hash(*cols: str) -> Column:
    """SHA-256 of a typed row: columns in sorted name order, nulls kept."""
    names = sorted(cols)
    return F.sha2(
        F.to_json(F.struct(*[F.col(c) for c in names]), {"ignoreNullFields": "false"}), 256
    )


def district_id(state: Column, child: Column) -> Column:
    """First 12 hex digits of md5("{state}_{child}"); NULL state -> '' (T18)."""
    return F.substring(
        F.md5(F.concat(F.coalesce(state.cast("string"), F.lit("")), F.lit("_"),
                       F.coalesce(child.cast("string"), F.lit("")))),
        1,
        12,
    )
