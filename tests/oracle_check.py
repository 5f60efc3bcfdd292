"""Run registered queries against their DuckDB oracle, the way the driver
compares them: columns by name, row count, order-insensitive values.

    python tests/oracle_check.py [sf_dir] [name ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6)
    if isinstance(v, decimal.Decimal):
        return str(v.normalize()) if v == v.to_integral() else format(v, "f").rstrip("0")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    keyed = sorted(repr(tuple(norm(r[i]) for i in order)) for r in rows)
    return hashlib.sha256("\n".join(keyed).encode()).hexdigest(), sorted(columns), keyed


def duck(sf_dir):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a]
    import __spark_entry__ as E
    from sysledger.session import get_session

    spark = get_session("local[8]")
    # the driver's session may differ from ours: CHECK_CONF="key=value,key=value"
    for item in filter(None, os.environ.get("CHECK_CONF", "").split(",")):
        key, value = item.split("=", 1)
        spark.conf.set(key, value)
    qs, oracle = E.queries(), E.oracle_sql()
    con = duck(sf_dir)
    bad = 0
    for name in names or sorted(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            srows = [tuple(r) for r in df.collect()]
            scols = df.columns
        except Exception as e:  # report and go on
            print(f"{name:28s} SPARK ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        t1 = time.time()
        if name not in oracle:
            print(f"{name:28s} rows={len(srows)} (no oracle) {t1 - t0:.1f}s")
            continue
        try:
            rel = con.execute(oracle[name])
            dcols = [d[0] for d in rel.description]
            drows = rel.fetchall()
        except Exception as e:
            print(f"{name:28s} ORACLE ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        hs, cs, ks = digest(scols, srows)
        hd, cd, kd = digest(dcols, drows)
        ok = hs == hd and cs == cd and len(srows) == len(drows)
        if not ok:
            bad += 1
            print(f"{name:28s} MISMATCH spark={len(srows)} oracle={len(drows)} cols_equal={cs == cd}")
            if cs != cd:
                print("   spark cols ", cs, "\n   oracle cols", cd)
            else:
                only_s = sorted(set(ks) - set(kd))[:3]
                only_d = sorted(set(kd) - set(ks))[:3]
                print("   spark only :", only_s, "\n   oracle only:", only_d)
        else:
            print(f"{name:28s} ok rows={len(srows)} {t1 - t0:.1f}s")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
