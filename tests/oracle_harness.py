"""Side-by-side check of a registered Spark query against its DuckDB SQL.

Usage: python tests/oracle_harness.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from granary.plans.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v
    if hasattr(v, "isoformat"):
        return v.isoformat(sep=" ") if hasattr(v, "hour") else v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    if hasattr(v, "item"):
        return _norm(v.item())
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    out.sort(key=lambda t: repr(t))
    return [cols[i] for i in order], out


def _close(a, b):
    if isinstance(a, float) and isinstance(b, (float, int)) or isinstance(b, float) and isinstance(a, (float, int)):
        return math.isclose(float(a), float(b), rel_tol=1e-9, abs_tol=1e-9)
    if isinstance(a, tuple) and isinstance(b, tuple):
        return len(a) == len(b) and all(_close(x, y) for x, y in zip(a, b))
    return a == b


def compare(spark, con, key, builder, sql, sf_dir):
    t0 = time.time()
    df = builder(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s_cols = df.columns
    t1 = time.time()
    if sql is None:
        return {"key": key, "status": "rows-only", "spark_rows": len(s_rows), "spark_s": round(t1 - t0, 2)}
    res = con.execute(sql)
    d_cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    t2 = time.time()
    sc, sr = _rows(s_cols, s_rows)
    dc, dr = _rows(d_cols, d_rows)
    info = {"key": key, "spark_rows": len(sr), "duck_rows": len(dr), "spark_s": round(t1 - t0, 2),
            "duck_s": round(t2 - t1, 2)}
    if sc != dc:
        info.update(status="SCHEMA", spark_cols=sc, duck_cols=dc)
    elif len(sr) != len(dr):
        info.update(status="ROWCOUNT")
    elif sr == dr:
        info.update(status="OK")
    elif all(_close(a, b) for a, b in zip(sr, dr)):
        info.update(status="APPROX")
    else:
        diffs = [(a, b) for a, b in zip(sr, dr) if not _close(a, b)]
        info.update(status="VALUES", ndiff=len(diffs), first=diffs[:2])
    return info


def main(argv):
    from granary.plans import registry
    from granary.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    keys = argv[2:]
    registry.load_all()
    spark = local_session(int(os.environ.get("HARNESS_CORES", "8")))
    con = duck(sf_dir)
    bad = 0
    for k in keys or sorted(registry.QUERIES):
        try:
            info = compare(spark, con, k, registry.QUERIES[k], registry.ORACLE.get(k), sf_dir)
        except Exception as e:  # report and continue
            info = {"key": k, "status": "ERROR", "error": repr(e)[:300]}
        if info["status"] not in ("OK", "rows-only"):
            bad += 1
        print(info, flush=True)
    print(f"done: {bad} not OK")


if __name__ == "__main__":
    main(sys.argv)
