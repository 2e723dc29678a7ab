"""Developer check: run registered queries in Spark and their oracle SQL in DuckDB, compare results.

    python -m edgegraph.plans.check [--sf /root/testdata/sf0.01] [name ...]

Comparison: same column names, same row count, same multiset of rows (floats rounded).
"""

from __future__ import annotations

import argparse
import json
import math
import os
import sys
import time

import duckdb
import pandas as pd

from edgegraph.plans.catalog import oracle_sql, queries
from edgegraph.sources.tables import TABLES, table_path


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = table_path(sf_dir, t)
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "item") and not isinstance(v, (list, dict, str, bytes)):
        try:
            return _norm(v.item())
        except (ValueError, AttributeError):
            pass
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if not isinstance(v, dict) and pd.isna(v):
        return None
    return v


def normalize(pdf: pd.DataFrame) -> list[tuple]:
    cols = sorted(pdf.columns)
    rows = [tuple(_norm(x) for x in r) for r in pdf[cols].itertuples(index=False, name=None)]
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, sf_dir: str, name: str, con=None, df=None) -> dict:
    qs, sqls = queries(), oracle_sql()
    t0 = time.time()
    sdf = (df if df is not None else qs[name](spark, sf_dir)).toPandas()
    t1 = time.time()
    out = {"query": name, "spark_rows": len(sdf), "spark_sec": round(t1 - t0, 2)}
    if name not in sqls:
        out["oracle"] = "none"
        return out
    con = con or duck(sf_dir)
    odf = con.execute(sqls[name]).df()
    out["oracle_rows"] = len(odf)
    out["oracle_sec"] = round(time.time() - t1, 2)
    out["columns_match"] = sorted(sdf.columns) == sorted(odf.columns)
    if not out["columns_match"]:
        out["spark_cols"], out["oracle_cols"] = sorted(sdf.columns), sorted(odf.columns)
        out["match"] = False
        return out
    a, b = normalize(sdf), normalize(odf)
    out["match"] = a == b
    if not out["match"]:
        sa, sb = set(a), set(b)
        out["only_spark"] = [str(x) for x in list(sa - sb)[:3]]
        out["only_oracle"] = [str(x) for x in list(sb - sa)[:3]]
    return out


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    args = ap.parse_args(argv)
    from edgegraph.session import get_spark
    spark = get_spark()
    names = args.names or sorted(queries())
    con = duck(args.sf)
    bad = 0
    for n in names:
        try:
            r = compare(spark, args.sf, n, con)
        except Exception as exc:  # noqa: BLE001
            r = {"query": n, "error": f"{type(exc).__name__}: {str(exc)[:400]}"}
        if r.get("match") is False or "error" in r:
            bad += 1
        print(json.dumps(r), flush=True)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
