"""Run registered queries against their SQL twins in DuckDB."""

from __future__ import annotations

import glob
import os
import sys
import time

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def duck(sf_dir: str):
    con = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return con


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if str(df[c].dtype).startswith("datetime"):
            df[c] = df[c].astype("datetime64[us]")
        elif df[c].dtype == object and len(df) and df[c].dropna().map(lambda v: hasattr(v, "isoformat")).all():
            df[c] = pd.to_datetime(df[c])
    order = [c for c in df.columns]
    return df.sort_values(order, key=lambda s: s.astype(str) if s.dtype == object else s, na_position="last").reset_index(drop=True)


def same(spark_pdf: pd.DataFrame, sql_pdf: pd.DataFrame) -> str | None:
    """None when equal (exact on keys, 1e-9 absolute on doubles), else the first difference."""
    if sorted(spark_pdf.columns) != sorted(sql_pdf.columns):
        return f"columns {sorted(spark_pdf.columns)} != {sorted(sql_pdf.columns)}"
    if len(spark_pdf) != len(sql_pdf):
        return f"rows {len(spark_pdf)} != {len(sql_pdf)}"
    a, b = _norm(spark_pdf), _norm(sql_pdf)
    for c in a.columns:
        fa, fb = pd.api.types.is_float_dtype(a[c]), pd.api.types.is_float_dtype(b[c])
        if pd.api.types.is_numeric_dtype(a[c]) and pd.api.types.is_numeric_dtype(b[c]) and a[c].dtype != bool:
            x, y = a[c].astype(float).to_numpy(), b[c].astype(float).to_numpy()
            bad = ~((np.abs(x - y) <= 1e-9 * np.maximum(1, np.abs(y))) | (np.isnan(x) & np.isnan(y)))
            if fa != fb and not (a[c].isna().any() or b[c].isna().any()):
                return f"{c}: type {a[c].dtype} != {b[c].dtype}"
        else:
            x, y = a[c].astype(object).where(a[c].notna(), None), b[c].astype(object).where(b[c].notna(), None)
            bad = (x.to_numpy() != y.to_numpy())
        if bad.any():
            i = int(np.argmax(bad))
            return f"{c}: {bad.sum()} of {len(a)} differ, first {a.loc[i].to_dict()} != {b.loc[i].to_dict()}"
    return None


def main(sf_dir: str, only: list[str]):
    from tidemark.plans.catalogue import ORACLES, QUERIES
    from tidemark.session import build_session
    spark = build_session("check")
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    bad = 0
    for name, fn in QUERIES.items():
        if only and not any(name.startswith(o) for o in only):
            continue
        t = time.time()
        try:
            got = fn(spark, sf_dir).toPandas()
            ts = time.time() - t
            if name not in ORACLES:
                print(f"rows {name:34s} {len(got):7d} {ts:6.2f}s", flush=True)
                continue
            t = time.time()
            want = con.execute(ORACLES[name]).df()
            why = same(got, want)
            print(f"{'ok  ' if why is None else 'BAD '} {name:34s} {len(got):7d} {ts:6.2f}s sql {time.time()-t:5.2f}s {why or ''}", flush=True)
            bad += why is not None
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"ERR  {name:34s} {type(e).__name__}: {str(e)[:1500]}", flush=True)
    print("bad:", bad)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
