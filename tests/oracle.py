"""Compare a catalogue query with its DuckDB oracle on the supplied tables.

Row count, column names (sorted) and an order-insensitive hash of the values
must agree.  Floats are compared after rounding to 9 significant digits, so
that summation order does not count as a difference.
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time

import duckdb

EXACT = bool(os.environ.get("ORACLE_EXACT"))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        if math.isinf(v):
            return "inf" if v > 0 else "-inf"
        return v if EXACT else float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    normed = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha1("\n".join(normed).encode()).hexdigest(), normed


def compare(spark, name, build, sql, sf_dir, con=None):
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = build(spark, sf_dir)
    srows = [tuple(r) for r in sdf.collect()]
    t1 = time.time()
    scols = list(sdf.columns)
    res = {"name": name, "spark_rows": len(srows), "spark_sec": round(t1 - t0, 2)}
    if sql is None:
        res["status"] = "rows-only"
        return res
    rel = con.execute(sql)
    dcols = [d[0] for d in rel.description]
    drows = rel.fetchall()
    res["duck_sec"] = round(time.time() - t1, 2)
    res["duck_rows"] = len(drows)
    ok_cols = sorted(scols) == sorted(dcols)
    hs, ns = _digest(scols, srows)
    hd, nd = _digest(dcols, drows)
    res["cols_ok"] = ok_cols
    res["hash_ok"] = hs == hd
    res["status"] = "ok" if (ok_cols and hs == hd and len(srows) == len(drows)) else "MISMATCH"
    if res["status"] != "ok":
        res["spark_cols"], res["duck_cols"] = scols, dcols
        a, b = set(ns), set(nd)
        res["only_spark"] = sorted(a - b)[:3]
        res["only_duck"] = sorted(b - a)[:3]
    return res


def main(argv):
    sys.path.insert(0, ".")
    import __spark_entry__ as E
    from kestrel.session import build_session
    sf_dir = "/root/testdata/sf0.01"
    names = argv or sorted(E.queries())
    spark = build_session()
    qs, sqls = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for n in names:
        try:
            r = compare(spark, n, qs[n], sqls.get(n), sf_dir, con)
        except Exception as e:  # report and continue
            r = {"name": n, "status": "ERROR", "error": str(e)[:800]}
        bad += r["status"] not in ("ok", "rows-only")
        print(r, flush=True)
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
