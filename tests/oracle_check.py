"""Compare queries() against oracle_sql() in DuckDB, as the driver does.

usage: python tests/oracle_check.py [sf_dir] [key ...]
"""

from __future__ import annotations

import math
import sys
import time

import duckdb

sys.path.insert(0, "/root/repo")

import __spark_entry__ as E  # noqa: E402
from cubeguard.session import local_session  # noqa: E402

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v)
    if hasattr(v, "item"):
        v = v.item()
    return repr(v)


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    keys = sys.argv[2:]
    spark = local_session()
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, os_ = E.queries(), E.oracle_sql()
    bad = 0
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            sdf = qs[k](spark, sf_dir)
            scols = sorted(sdf.columns)
            srows = [tuple(norm(r[c]) for c in scols) for r in sdf.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{k}: SPARK ERROR {type(e).__name__}: {str(e)[:400]}")
            bad += 1
            continue
        ts = time.time() - t0
        if k not in os_:
            print(f"{k}: rows={len(srows)} (no oracle) {ts:.1f}s")
            continue
        try:
            res = con.execute(os_[k])
            dcols = [d[0] for d in res.description]
            drows_raw = res.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{k}: DUCKDB ERROR {str(e)[:600]}")
            bad += 1
            continue
        if sorted(dcols) != scols:
            print(f"{k}: COLUMN MISMATCH spark={scols} duck={sorted(dcols)}")
            bad += 1
            continue
        idx = [dcols.index(c) for c in scols]
        drows = [tuple(norm(r[i]) for i in idx) for r in drows_raw]
        same = sorted(srows) == sorted(drows)
        status = "OK" if same else "VALUE MISMATCH"
        if not same:
            bad += 1
            ss, dd = set(srows), set(drows)
            only_s = sorted(ss - dd)[:3]
            only_d = sorted(dd - ss)[:3]
            print(f"  cols={scols}")
            print(f"  spark-only={only_s}")
            print(f"  duck-only={only_d}")
        print(f"{k}: {status} rows spark={len(srows)} duck={len(drows)} {ts:.1f}s")
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
