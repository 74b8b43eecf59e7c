"""Local stand-in for the driver's correctness gate (Spark vs DuckDB).

    python tests/compare.py [sf_dir] [name ...]

Compares row count, column names and an order-insensitive multiset of
normalised rows.  Prints one line per query and a summary.
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import duckdb  # noqa: E402

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 3)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 3)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((str(k), norm(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(norm(x) for x in v)
    return v


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    names = [a for a in args if not a.startswith("/")]
    import __spark_entry__ as E
    from kestrel.session import get_session

    import os

    if os.environ.get("PLAIN"):
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.master("local[*]").config("spark.sql.shuffle.partitions", "8").getOrCreate()
    else:
        spark = get_session("local[8]", 8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, orc = E.queries(), E.oracle_sql()
    bad = 0
    for name in names or list(qs):
        t0 = time.time()
        try:
            sdf = qs[name](spark, sf_dir)
            cols = sorted(sdf.columns)
            srows = Counter(tuple(norm(r[c]) for c in cols) for r in sdf.collect())
            ts = time.time() - t0
            if name not in orc:
                print(f"{name:40s} rows-only  spark={sum(srows.values())}  {ts:.1f}s")
                continue
            rel = con.sql(orc[name])
            dcols = rel.columns
            drows_raw = rel.fetchall()
            if sorted(dcols) != cols:
                print(f"{name:40s} COLUMNS DIFFER spark={cols} duck={sorted(dcols)}")
                bad += 1
                continue
            idx = [dcols.index(c) for c in cols]
            drows = Counter(tuple(norm(r[i]) for i in idx) for r in drows_raw)
            ok = srows == drows
            print(f"{name:40s} {'OK ' if ok else 'DIFF'} spark={sum(srows.values())} duck={sum(drows.values())} {ts:.1f}s")
            if not ok:
                bad += 1
                print("   spark-only:", list((srows - drows).items())[:3])
                print("   duck-only: ", list((drows - srows).items())[:3])
        except Exception as e:  # noqa: BLE001
            bad += 1
            print(f"{name:40s} ERROR {type(e).__name__}: {str(e)[:400]}")
    print("FAILED" if bad else "ALL OK", bad)


if __name__ == "__main__":
    main()
