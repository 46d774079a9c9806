"""Run registered queries in Spark and their oracle SQL in DuckDB, compare results.

Usage: python tests/oracle.py [sf_dir] [name ...]
Comparison: same row count, same column names, same multiset of rows after rounding
floats to 6 significant decimals (engines differ in the last bits of float sums).
"""

from __future__ import annotations

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    import numpy as np
    if v is None:
        return None
    if isinstance(v, np.ndarray):
        return tuple(_norm(x) for x in v.tolist())
    if v is pd_NA():
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if hasattr(v, "item"):
        return _norm(v.item())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if hasattr(v, "isoformat"):
        return str(v)[:26].replace("T", " ")
    return v


def pd_NA():
    import pandas as pd
    return pd.NA


def _scalar_na(x):
    import pandas as pd
    if x is None or isinstance(x, (str, bytes)):
        return x is None
    if hasattr(x, "__len__"):
        return False
    try:
        return bool(pd.isna(x)) and not isinstance(x, float)
    except (TypeError, ValueError):
        return False


def rows_of(pdf):
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(None if _scalar_na(x) else _norm(x) for x in rec))
    return cols, sorted(out, key=repr)


def compare(spark, sf_dir, name, fn, sql, con):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    spdf = sdf.toPandas()
    ts = time.time() - t0
    if sql is None:
        return {"name": name, "ok": None, "rows": len(spdf), "spark_s": round(ts, 2)}
    t0 = time.time()
    dpdf = con.execute(sql).df()
    td = time.time() - t0
    scols, srows = rows_of(spdf)
    dcols, drows = rows_of(dpdf)
    ok = scols == dcols and srows == drows
    res = {"name": name, "ok": ok, "rows": len(srows), "oracle_rows": len(drows),
           "spark_s": round(ts, 2), "duck_s": round(td, 3)}
    if not ok:
        res["cols"] = (scols, dcols) if scols != dcols else None
        diff_s = [r for r in srows if r not in set(drows)][:3]
        diff_d = [r for r in drows if r not in set(srows)][:3]
        res["spark_only"] = diff_s
        res["oracle_only"] = diff_d
    return res


def main():
    from lendnet.session import get_session
    from lendnet.plans.catalog import load_all
    args = sys.argv[1:]
    sf_dir = "/root/testdata/sf0.01"
    if args and args[0].startswith("/"):
        sf_dir = args.pop(0)
    reg = load_all()
    names = args or list(reg)
    spark = get_session("local[8]")
    con = duck(sf_dir)
    bad = 0
    for n in names:
        fn, sql = reg[n]
        try:
            r = compare(spark, sf_dir, n, fn, sql, con)
        except Exception as e:  # report and continue
            r = {"name": n, "ok": False, "error": repr(e)[:600]}
        if r.get("ok") is False:
            bad += 1
        print(r, flush=True)
    print(f"DONE {len(names)} queries, {bad} failing", flush=True)


if __name__ == "__main__":
    main()
