"""Compare registered Spark queries with their DuckDB oracle SQL.

Usable from pytest (``test_oracle.py``) and as a script while developing:

    python tests/oracle_harness.py /root/testdata/sf0.01 [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time

import duckdb
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


def _norm_value(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return tuple(_norm_value(x) for x in v)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    return v


def normalise(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    rows = [tuple(_norm_value(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str, con) -> dict:
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    s_pd = sdf.toPandas()
    t1 = time.time()
    d_pd = con.sql(sql).df()
    t2 = time.time()
    out = {"name": name, "spark_rows": len(s_pd), "duck_rows": len(d_pd),
           "spark_s": round(t1 - t0, 2), "duck_s": round(t2 - t1, 2)}
    out["columns_match"] = sorted(s_pd.columns) == sorted(d_pd.columns)
    if not out["columns_match"]:
        out["spark_cols"], out["duck_cols"] = list(s_pd.columns), list(d_pd.columns)
        out["match"] = False
        return out
    a, b = normalise(s_pd), normalise(d_pd)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = list(sa - sb)[:3]
        out["only_duck"] = list(sb - sa)[:3]
    return out


def main(argv: list[str]) -> int:
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    from textmill.plans.catalog import oracle_sql, queries
    from textmill.session import build_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:]
    spark = build_session("local[8]", 8)
    qs, sqls = queries(), oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in (names or list(qs)):
        if name not in sqls:
            t0 = time.time()
            n = qs[name](spark, sf_dir).count()
            print({"name": name, "rows_only": n, "spark_s": round(time.time() - t0, 2)}, flush=True)
            continue
        try:
            r = compare(spark, name, qs[name], sqls[name], sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": name, "error": repr(e)[:2000], "match": False}
        bad += not r.get("match")
        print(r, flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv))
