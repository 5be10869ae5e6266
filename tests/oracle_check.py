"""Run registered queries in Spark and their oracle SQL in DuckDB; compare.

    python -m tests.oracle_check [sf_dir] [key ...]

Compares column names, row counts and the multiset of rows (floats compared
to 9 significant digits, timestamps as ISO text).
"""

from __future__ import annotations

import datetime as dt
import math
import sys
import time
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    if hasattr(v, "is_integer") and not isinstance(v, bool):  # Decimal
        return norm(float(v))
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return Counter(tuple(norm(r[i]) for i in order) for r in rows)


def compare(spark, sf_dir: str, keys=None, verbose=True):
    import importlib
    entry = importlib.import_module("__spark_entry__")
    qs, sql = entry.queries(), entry.oracle_sql()
    con = duck(sf_dir)
    results = {}
    for k in keys or sorted(qs):
        t0 = time.time()
        try:
            df = qs[k](spark, sf_dir)
            s_cols = df.columns
            s_rows = [tuple(r) for r in df.collect()]
        except Exception as e:  # noqa: BLE001
            results[k] = f"SPARK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(k, results[k], flush=True)
            continue
        t1 = time.time()
        if k not in sql:
            results[k] = f"rows-only {len(s_rows)}"
            print(f"{k}: {results[k]} ({t1 - t0:.1f}s)", flush=True)
            continue
        try:
            cur = con.execute(sql[k])
            d_cols = [c[0] for c in cur.description]
            d_rows = cur.fetchall()
        except Exception as e:  # noqa: BLE001
            results[k] = f"DUCK ERROR {type(e).__name__}: {str(e)[:300]}"
            print(k, results[k], flush=True)
            continue
        if sorted(s_cols) != sorted(d_cols):
            results[k] = f"COLUMNS spark={sorted(s_cols)} duck={sorted(d_cols)}"
        elif len(s_rows) != len(d_rows):
            results[k] = f"ROWCOUNT spark={len(s_rows)} duck={len(d_rows)}"
        else:
            a, b = rows_of(s_cols, s_rows), rows_of(d_cols, d_rows)
            if a == b:
                results[k] = f"ok {len(s_rows)}"
            else:
                only_s = list((a - b).elements())[:3]
                only_d = list((b - a).elements())[:3]
                results[k] = f"VALUES spark-only={only_s} duck-only={only_d}"
        print(f"{k}: {results[k]} ({t1 - t0:.1f}s)", flush=True)
    return results


if __name__ == "__main__":
    sys.path.insert(0, ".")
    from vintagecast.session import get_spark
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", 8)
    spark.sparkContext.setLogLevel("ERROR")
    res = compare(spark, sf, sys.argv[2:] or None)
    bad = {k: v for k, v in res.items() if not (v.startswith("ok") or v.startswith("rows-only"))}
    print(f"\n{len(res) - len(bad)}/{len(res)} fine; failing: {sorted(bad)}")
