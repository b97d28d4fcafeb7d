"""Driver-style check: every query against its DuckDB twin at one scale factor.

    python tests/compare_oracle.py /root/testdata/sf0.01 [query ...]

Exact values (no float tolerance), order-insensitive, plus column names and
types; runs on a plain SparkSession like the driver's.
"""

import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as E  # noqa: E402

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
DUCK = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "boolean": "BOOLEAN"}


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return repr(v)


def canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(tuple(norm(r[i]) for i in order) for r in rows)


def main() -> int:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    only = set(sys.argv[2:])
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    spark = SparkSession.builder.master("local[8]").getOrCreate()
    bad = 0
    for name, fn in E.queries().items():
        if only and name not in only or name not in E.oracle_sql():
            continue
        t0 = time.time()
        df = fn(spark, sf)
        got = canon(df.columns, [tuple(r) for r in df.collect()])
        res = con.sql(E.oracle_sql()[name])
        want = canon(res.columns, res.fetchall())
        types_ok = {c: DUCK.get(t, t) for c, t in df.dtypes} == dict(zip(res.columns, map(str, res.types)))
        ok = got == want and sorted(df.columns) == sorted(res.columns) and types_ok
        bad += not ok
        print(f"{'OK  ' if ok else 'FAIL'} {name}: {len(got)} rows, {time.time() - t0:.1f}s")
    print("failures:", bad)
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
