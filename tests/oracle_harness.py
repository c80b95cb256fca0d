"""Side-by-side check of ``queries()`` against ``oracle_sql()`` (DuckDB), as the driver does:
row count, column names and an order-insensitive comparison of the values.

Usage: python tests/oracle_harness.py [sf_dir] [name ...]
"""

from __future__ import annotations

import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None or v is pd.NA or v is pd.NaT:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = []
    for rec in df[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(x) for x in rec))
    return sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def compare(spark, sf_dir: str, names=None, verbose=True) -> dict:
    import __spark_entry__ as entry
    qs, sqls = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            sarrow = sdf.toArrow()
            pdf = sarrow.to_pandas()
        except Exception as e:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"spark: {e}"[:500]}
            if verbose:
                print(name, "SPARK ERROR", str(e)[:800])
            continue
        ts = time.time() - t0
        if name not in sqls:
            results[name] = {"ok": None, "rows": len(pdf), "note": "no oracle", "sec": ts}
            if verbose:
                print(f"{name}: rows={len(pdf)} (no oracle) {ts:.1f}s")
            continue
        try:
            oarrow = con.sql(sqls[name]).to_arrow_table()
            odf = oarrow.to_pandas()
        except Exception as e:  # noqa: BLE001
            results[name] = {"ok": False, "error": f"duckdb: {e}"[:500]}
            if verbose:
                print(name, "DUCKDB ERROR", str(e)[:800])
            continue
        same_cols = sorted(pdf.columns) == sorted(odf.columns)
        st = {f.name: str(f.type) for f in sarrow.schema}
        ot = {f.name: str(f.type) for f in oarrow.schema}
        type_diff = {k: (st.get(k), ot.get(k)) for k in set(st) | set(ot) if st.get(k) != ot.get(k)}
        same_cols = same_cols and not type_diff
        same_n = len(pdf) == len(odf)
        same_vals = same_cols and same_n and _rows(pdf) == _rows(odf)
        ok = same_cols and same_n and same_vals
        results[name] = {"ok": ok, "rows": len(pdf), "oracle_rows": len(odf), "sec": ts}
        if verbose:
            print(f"{name}: ok={ok} rows={len(pdf)}/{len(odf)} cols={same_cols} {ts:.1f}s")
            if not ok:
                print("  spark cols", sorted(pdf.columns), "\n  duck cols ", sorted(odf.columns))
                if type_diff:
                    print("  type differences (spark, duckdb):", type_diff)
                if same_cols and same_n:
                    a, b = _rows(pdf), _rows(odf)
                    diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
                    print("  first diffs:", diff)
                print("  spark dtypes", dict(pdf.dtypes), "\n  duck dtypes", dict(odf.dtypes))
    return results


if __name__ == "__main__":
    from keyloop.session import build_session
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session(shuffle_partitions=8)
    if os.environ.get("HARNESS_TZ"):   # check that results do not depend on the session zone
        spark.conf.set("spark.sql.session.timeZone", os.environ["HARNESS_TZ"])
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = [k for k, v in res.items() if v.get("ok") is False]
    print("FAILED:", bad)
    print(f"{sum(1 for v in res.values() if v.get('ok'))} ok, {len(bad)} failed, "
          f"{sum(1 for v in res.values() if v.get('ok') is None)} rows-only")
