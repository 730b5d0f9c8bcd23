"""Spark-vs-DuckDB comparison used by the tests and by hand:

    python tests/harness.py [sf] [name ...]

Each query's Spark result and its oracle SQL result are compared as
multisets of rows (columns by name, floats to 1e-9 relative).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402

from zonewatch.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        if math.isnan(v):
            return (1, "nan")
        return (2, float(f"{v:.10g}"))
    if isinstance(v, bool):
        return (3, int(v))
    if isinstance(v, (bytes, bytearray, memoryview)):
        return (4, bytes(v).hex())
    if isinstance(v, (list, tuple)):
        return (5, tuple(_norm(x) for x in v))
    if hasattr(v, "isoformat"):
        return (6, v.isoformat())
    if isinstance(v, dict):
        return (7, tuple(sorted((k, _norm(x)) for k, x in v.items())))
    if hasattr(v, "asDict"):
        return _norm(v.asDict())
    return (8, v) if isinstance(v, (int, str)) else (9, str(v))


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_norm(r[c]) for c in cols) for r in df.select(*cols).collect())


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())


def compare(spark, con, name: str, sf_dir: str):
    from zonewatch.plans.catalog import QUERIES
    e = QUERIES[name]
    t = time.time()
    sc, sr = rows_of_spark(e.build(spark, sf_dir))
    ts = time.time() - t
    if e.oracle is None:
        return {"name": name, "ok": None, "rows": len(sr), "spark_s": round(ts, 2)}
    t = time.time()
    dc, dr = rows_of_duck(con, e.oracle)
    td = time.time() - t
    ok = sc == dc and sr == dr
    out = {"name": name, "ok": ok, "rows": len(sr), "oracle_rows": len(dr),
           "spark_s": round(ts, 2), "duck_s": round(td, 2)}
    if not ok:
        out["spark_cols"], out["duck_cols"] = sc, dc
        if sc == dc:
            s_only = [r for r in sr if r not in set(dr)][:3]
            d_only = [r for r in dr if r not in set(sr)][:3]
            out["spark_only"], out["duck_only"] = s_only, d_only
    return out


def main(argv):
    sf = argv[1] if len(argv) > 1 else "0.01"
    sf_dir = f"/root/testdata/sf{sf}"
    from zonewatch.session import build_session
    from zonewatch.plans.catalog import QUERIES
    spark = build_session("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    names = argv[2:] or list(QUERIES)
    bad = 0
    for n in names:
        try:
            r = compare(spark, con, n, sf_dir)
        except Exception as exc:  # report and go on
            r = {"name": n, "ok": False, "error": str(exc).splitlines()[0][:300]}
        bad += r.get("ok") is False
        print(r, flush=True)
    print("failed:", bad)


if __name__ == "__main__":
    main(sys.argv)
