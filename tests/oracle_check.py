"""Run every registered query on Spark and its DuckDB statement; compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names and the order-insensitive multiset of
values (floats compared after rounding to 6 places).
"""

from __future__ import annotations

import decimal
import math
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def _norm(v):
    if isinstance(v, float):
        return ("nan",) if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    return v


def _key(row):
    return tuple((x is None, str(type(x)), x if x is not None else 0) for x in row)


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> tuple[bool, str]:
    t0 = time.time()
    sdf = query(spark, sf_dir)
    srows = [tuple(_norm(v) for v in r) for r in sdf.collect()]
    scols = sdf.columns
    t1 = time.time()
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    drows = [tuple(_norm(v) for v in r) for r in res.fetchall()]
    if sorted(scols) != sorted(dcols):
        return False, f"columns differ: spark={scols} duckdb={dcols}"
    order = [dcols.index(c) for c in scols]
    drows = [tuple(r[i] for i in order) for r in drows]
    if len(srows) != len(drows):
        return False, f"row count spark={len(srows)} duckdb={len(drows)}"
    a, b = sorted(srows, key=_key), sorted(drows, key=_key)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        return False, f"values differ, e.g. {diff}"
    return True, f"{len(srows)} rows, spark {t1 - t0:.2f}s"


def main(argv: list[str]) -> int:
    from __spark_entry__ import oracle_sql, queries
    from refyield.session import get_spark

    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    names = argv[1:]
    spark = get_spark("local[8]", shuffle_partitions=8, conf={"spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = duck(sf_dir)
    qs, sql = queries(), oracle_sql()
    bad = 0
    for name in names or list(qs):
        if name not in sql:
            print(f"{name:40s} (no oracle)")
            continue
        ok, msg = compare(spark, con, name, qs[name], sql[name], sf_dir)
        bad += not ok
        print(f"{name:40s} {'OK ' if ok else 'BAD'} {msg}")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
