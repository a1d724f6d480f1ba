"""Run registered queries in Spark and their oracle SQL in DuckDB; compare rows, schema and values.

usage: python tools/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import hashlib
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from acoustispark.sources.tables import TABLES  # noqa: E402


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        return int(v) if v.is_integer() and abs(v) < 2 ** 53 else round(v, 6)
    if isinstance(v, (list, tuple)):
        return [_norm(x) for x in v]
    if isinstance(v, dict):
        return {k: _norm(x) for k, x in sorted(v.items())}
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def frame_digest(df: pd.DataFrame) -> tuple[int, list[str], str]:
    cols = sorted(df.columns)
    rows = [json.dumps([_norm(r[c]) for c in cols], default=str) for _, r in df.iterrows()]
    rows.sort()
    return len(rows), cols, hashlib.sha256("\n".join(rows).encode()).hexdigest()


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir).toPandas()
    t1 = time.time()
    if sql is None:
        return {"name": name, "rows": len(sdf), "spark_s": round(t1 - t0, 2), "oracle": None}
    ddf = con.execute(sql).df()
    t2 = time.time()
    a, b = frame_digest(sdf), frame_digest(ddf)
    res = {"name": name, "rows": a[0], "oracle_rows": b[0], "cols_ok": a[1] == b[1], "hash_ok": a[2] == b[2],
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    if a[1] != b[1]:
        res["spark_cols"], res["oracle_cols"] = a[1], b[1]
    elif a[2] != b[2]:
        cols = a[1]
        sa = sorted(json.dumps([_norm(r[c]) for c in cols], default=str) for _, r in sdf.iterrows())
        sb = sorted(json.dumps([_norm(r[c]) for c in cols], default=str) for _, r in ddf.iterrows())
        in_a, in_b = set(sa), set(sb)
        only_a = [x for x in sa if x not in in_b][:3]
        only_b = [x for x in sb if x not in in_a][:3]
        res["spark_only"], res["oracle_only"] = only_a, only_b
    return res


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and argv[1].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if not a.startswith("/")]
    from acoustispark.plans import registry
    from acoustispark.session import get_session
    spark = get_session("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    reg = registry()
    bad = 0
    for name, (fn, sql) in reg.items():
        if names and name not in names:
            continue
        try:
            r = compare(spark, con, name, fn, sql, sf_dir)
        except Exception as e:  # report and go on
            r = {"name": name, "error": f"{type(e).__name__}: {str(e)[:400]}"}
        ok = "error" not in r and (r.get("oracle") is None and "hash_ok" not in r or (r.get("hash_ok") and r.get("rows") == r.get("oracle_rows")))
        bad += 0 if ok else 1
        print("\n" + ("OK  " if ok else "BAD ") + json.dumps(r, default=str), flush=True)
    print(f"{bad} bad")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
