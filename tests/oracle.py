"""Run registered queries on Spark and their SQL on DuckDB over the same parquet tables and compare the results.

Usage: python tests/oracle.py /root/testdata/sf0.01 [query ...]
"""

from __future__ import annotations

import datetime as dt
import decimal
import math
import os
import sys
import tempfile
import time
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return float(f"{v:.9g}")
    if isinstance(v, decimal.Decimal):
        return float(f"{float(v):.9g}")
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (bytes, bytearray)):
        return bytes(v).hex()
    return v


def duck(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(spark, con, name, fn, sql, sf_dir):
    t0 = time.time()
    sdf = fn(spark, sf_dir)
    cols = sdf.columns
    srows = [tuple(norm(r[c]) for c in sorted(cols)) for r in (row.asDict() for row in sdf.collect())]
    t1 = time.time()
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = [tuple(norm(dict(zip(dcols, r))[c]) for c in sorted(dcols)) for r in cur.fetchall()]
    ok_cols = sorted(cols) == sorted(dcols)
    ok_rows = len(srows) == len(drows)
    ok_vals = Counter(srows) == Counter(drows)
    detail = ""
    if not (ok_cols and ok_vals):
        a, b = Counter(srows), Counter(drows)
        detail = f"cols spark={sorted(cols)} duck={sorted(dcols)}; only spark={list((a - b).items())[:3]}; " \
                 f"only duck={list((b - a).items())[:3]}"
    return ok_cols and ok_rows and ok_vals, len(srows), t1 - t0, detail


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession

    import __spark_entry__ as e

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.sql.shuffle.partitions", "8").config("spark.ui.showConsoleProgress", "false").config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="oracle-")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    qs, sqls = e.queries(), e.oracle_sql()
    names = argv[2:] or list(qs)
    con = duck(sf_dir)
    bad = 0
    for n in names:
        if n not in sqls:
            rows = qs[n](spark, sf_dir).count()
            print(f"{n:28s} rows-only  rows={rows}")
            continue
        try:
            ok, rows, secs, detail = compare(spark, con, n, qs[n], sqls[n], sf_dir)
        except Exception as ex:  # noqa: BLE001
            ok, rows, secs, detail = False, -1, 0, f"{type(ex).__name__}: {str(ex)[:300]}"
        bad += not ok
        print(f"{n:28s} {'OK ' if ok else 'BAD'} rows={rows} {secs:.2f}s {detail}")
    print(f"{len(names) - bad}/{len(names)} ok")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv) else 0)
