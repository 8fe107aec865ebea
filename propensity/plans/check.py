"""Local correctness gate: run each registered query in Spark and its
oracle in DuckDB on the same parquet tables, then compare row count,
column names and an order-insensitive value hash.

    python -m propensity.plans.check [--sf DIR] [name ...]
"""

from __future__ import annotations

import argparse
import hashlib
import math
import sys
import time

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations"]


def _norm(v):
    import datetime as dt

    import numpy as np
    import pandas as pd
    if v is None:
        return None
    if isinstance(v, float) or isinstance(v, np.floating):
        f = float(v)
        if math.isnan(f):
            return None
        return round(f, 6) + 0.0
    if isinstance(v, (bool, np.bool_)):
        return int(v)
    if isinstance(v, (int, np.integer)):
        return int(v)
    if isinstance(v, (pd.Timestamp, dt.datetime)):
        return str(pd.Timestamp(v).tz_localize(None) if getattr(v, "tzinfo", None) else pd.Timestamp(v))
    if v is pd.NaT:
        return None
    if isinstance(v, (list, tuple, np.ndarray)):
        return tuple(_norm(x) for x in v)
    try:
        if pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    return v


def _rows(pdf):
    cols = sorted(pdf.columns, key=str.lower)
    out = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        out.append(tuple(_norm(v) for v in rec))
    return cols, sorted(out, key=repr)


def digest(pdf) -> tuple[list[str], int, str, list]:
    cols, rows = _rows(pdf)
    h = hashlib.sha256(repr(rows).encode()).hexdigest()[:16]
    return [c.lower() for c in cols], len(rows), h, rows


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv=None) -> int:
    ap = argparse.ArgumentParser()
    ap.add_argument("--sf", default="/root/testdata/sf0.01")
    ap.add_argument("names", nargs="*")
    a = ap.parse_args(argv)
    sys.path.insert(0, ".")
    from propensity.plans.catalog import oracle_sql, queries
    from propensity.session import local_session
    spark = local_session()
    con = duck(a.sf)
    qs, orc = queries(), oracle_sql()
    names = a.names or list(qs)
    bad = 0
    for n in names:
        t0 = time.time()
        try:
            sp = qs[n](spark, a.sf).toPandas()
        except Exception as e:  # report and continue
            print(f"FAIL {n}: spark error {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        dt = time.time() - t0
        if n not in orc:
            print(f"ROWS {n}: {len(sp)} rows ({dt:.1f}s) cols={list(sp.columns)}")
            continue
        try:
            od = con.execute(orc[n]).fetchdf()
        except Exception as e:
            print(f"FAIL {n}: duckdb error {str(e)[:400]}")
            bad += 1
            continue
        sc, sn, sh, srows = digest(sp)
        oc, on, oh, orows = digest(od)
        if sc == oc and sn == on and sh == oh:
            sd = {c.lower(): str(t) for c, t in sp.dtypes.items()}
            od_ = {c.lower(): str(t) for c, t in od.dtypes.items()}
            diff = {c: (sd[c], od_.get(c)) for c in sd if sd[c] != od_.get(c)}
            note = f"  dtype differences: {diff}" if diff else ""
            print(f"OK   {n}: {sn} rows ({dt:.1f}s){note}")
            continue
        bad += 1
        print(f"FAIL {n}: cols {sc} vs {oc}; rows {sn} vs {on}")
        if sc == oc and sn == on:
            diff = [(x, y) for x, y in zip(srows, orows) if x != y]
            print(f"     {len(diff)} differing rows, e.g.")
            for x, y in diff[:3]:
                print("     spark ", x)
                print("     oracle", y)
        print("     spark dtypes", dict(sp.dtypes.astype(str)))
        print("     duck  dtypes", dict(od.dtypes.astype(str)))
    print(f"{len(names) - bad}/{len(names)} ok")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
