"""Run registered Spark queries next to their DuckDB oracle SQL and compare.

Comparison: same column names, same row count, and the same multiset of
rows after normalising values (floats to 6 decimals, timestamps to ISO text,
arrays to tuples). This mirrors the driver's row-count + schema + hash check.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        if math.isnan(v):
            return None
        return round(float(v), 6) + 0.0
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6) + 0.0
    if isinstance(v, (np.integer,)):
        return int(v)
    if isinstance(v, bool) or isinstance(v, np.bool_):
        return bool(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return pd.Timestamp(v).tz_localize(None).isoformat() if pd.Timestamp(v).tzinfo else pd.Timestamp(v).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    if v is pd.NaT:
        return None
    return v


def _rows(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    out.sort(key=lambda r: tuple((x is None, str(x)) for x in r))
    return out


def compare(spark, name: str, q, sf_dir: str, con=None) -> dict:
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = q.fn(spark, sf_dir)
    spdf = sdf.toPandas()
    t1 = time.time()
    res = {"name": name, "spark_rows": len(spdf), "spark_sec": round(t1 - t0, 2)}
    if q.sql is None:
        res["status"] = "rows-only"
        return res
    opdf = con.sql(q.sql).df()
    res["oracle_rows"] = len(opdf)
    if sorted(spdf.columns) != sorted(opdf.columns):
        res["status"] = f"COLUMNS {sorted(spdf.columns)} != {sorted(opdf.columns)}"
        return res
    a, b = _rows(spdf), _rows(opdf)
    if a == b:
        res["status"] = "match"
    else:
        diff_a = [r for r in a if r not in set(b)][:3]
        diff_b = [r for r in b if r not in set(a)][:3]
        res["status"] = "MISMATCH"
        res["spark_only"] = [str(r)[:300] for r in diff_a]
        res["oracle_only"] = [str(r)[:300] for r in diff_b]
    return res


def main(argv):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from colloquy.plans.registry import load_all
    from colloquy.session import build_session

    sf_dir = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = argv[1:]
    reg = load_all()
    spark = build_session()
    con = duck(sf_dir)
    bad = 0
    for name, q in reg.items():
        if names and not any(name.startswith(n) for n in names):
            continue
        try:
            r = compare(spark, name, q, sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "status": f"ERROR {type(e).__name__}: {str(e)[:400]}"}
        if r["status"] not in ("match", "rows-only"):
            bad += 1
        print(r, flush=True)
    print(f"not matching: {bad}")
    spark.stop()


if __name__ == "__main__":
    main(sys.argv)
