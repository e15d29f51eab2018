"""Spark query vs DuckDB oracle, compared the way the driver does it:
columns sorted by name, doubles rounded, order-insensitive row hash."""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(round(v, 6) + 0.0)
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, int):
        return str(v)
    if v is None:
        return "None"
    return str(v)


def digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("\x1f".join(_norm(r[i]) for i in order) for r in rows)
    h = hashlib.sha256("\x1e".join(lines).encode()).hexdigest()
    return [cols[i] for i in order], lines, h


def compare(spark, name, builder, sql, sf_dir, con=None, verbose=True):
    con = con or duck(sf_dir)
    t0 = time.time()
    df = builder(spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    scols = df.columns
    t1 = time.time()
    rel = con.sql(sql)
    dcols = rel.columns
    drows = rel.fetchall()
    t2 = time.time()
    sc, sl, sh = digest(scols, srows)
    dc, dl, dh = digest(dcols, drows)
    ok = sc == dc and sh == dh
    if verbose:
        print(f"{'OK ' if ok else 'BAD'} {name}: spark {len(srows)} rows {t1 - t0:.1f}s, "
              f"duck {len(drows)} rows {t2 - t1:.1f}s")
        if not ok:
            if sc != dc:
                print("   columns spark", sc, "duck", dc)
            else:
                a, b = set(sl), set(dl)
                for x in sorted(a - b)[:5]:
                    print("   spark-only:", x[:300])
                for x in sorted(b - a)[:5]:
                    print("   duck-only: ", x[:300])
    return ok


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    from ticketloom.session import build_session
    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:]
    spark = build_session()
    qs, os_ = E.queries(), E.oracle_sql()
    con = duck(sf)
    bad = []
    for n in (names or list(qs)):
        if n not in os_:
            df = qs[n](spark, sf)
            print(f"R   {n}: {df.count()} rows (no oracle)")
            continue
        try:
            if not compare(spark, n, qs[n], os_[n], sf, con):
                bad.append(n)
        except Exception as e:  # keep going over the catalog
            print(f"ERR {n}: {type(e).__name__}: {str(e)[:400]}")
            bad.append(n)
    print("FAILED:", bad)
