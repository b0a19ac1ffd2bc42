"""Local twin of the driver's correctness gate: Spark query vs SQL twin in DuckDB.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and an order-insensitive hash of the rows.
"""

from __future__ import annotations

import hashlib
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
          "labels conversations").split()


STRICT = os.environ.get("STRICT", "0") == "1"


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        # STRICT=1: exact values (as a strict driver would hash them); otherwise 6 decimals
        return repr(v + 0.0) if STRICT else repr(round(v, 6) + 0.0)
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if isinstance(v, dict):
        return "{" + ",".join(f"{k}:{_norm(x)}" for k, x in sorted(v.items())) + "}"
    return repr(v)


def digest(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.sha256("\n".join(lines).encode()).hexdigest(), lines


def main():
    import duckdb

    from __spark_entry__ import oracle_sql, queries
    from modenorm.session import get_spark

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark = get_spark(shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            df = qs[name](spark, sf_dir)
            scols = df.columns
            srows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} SPARK-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        ts = time.time() - t0
        if name not in sqls:
            print(f"{name:22s} rows-only  spark_rows={len(srows)} ({ts:.1f}s)")
            continue
        try:
            cur = con.execute(sqls[name])
            dcols = [c[0] for c in cur.description]
            drows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            print(f"{name:22s} SQL-ERROR {type(e).__name__}: {str(e)[:300]}")
            bad += 1
            continue
        hs, ls = digest(srows, scols)
        hd, ld = digest(drows, dcols)
        ok = sorted(scols) == sorted(dcols) and len(srows) == len(drows) and hs == hd
        status = "OK" if ok else "MISMATCH"
        print(f"{name:22s} {status:8s} rows={len(srows)}/{len(drows)} ({ts:.1f}s)")
        if not ok:
            bad += 1
            if sorted(scols) != sorted(dcols):
                print("   cols spark:", scols, "\n   cols sql:  ", dcols)
            else:
                diff = [x for x in ls if x not in set(ld)][:3]
                diff2 = [x for x in ld if x not in set(ls)][:3]
                print("   spark-only:", diff, "\n   sql-only:  ", diff2)
    print("FAILED" if bad else "ALL OK", bad)
    spark.stop()


if __name__ == "__main__":
    main()
