"""Runs queries and their SQL side by side: python -m tests.compare SF [NAME...]"""

import sys
import time
from pathlib import Path

import duckdb


def plain(v):
    import math

    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple((k, plain(x)) for k, x in sorted(v.items()))
    if hasattr(v, "asDict"):
        return tuple((k, plain(x)) for k, x in sorted(v.asDict().items()))
    return v


def oracle(sf_dir):
    con = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p}{'/*.parquet' if p.is_dir() else ''}')")
    return con


def same(df, con, sql):
    """(equal, Spark rows, SQL rows, differences)"""
    cols = sorted(df.columns)
    a = sorted((plain(tuple(r)) for r in df.select(*cols).collect()), key=repr)
    rel = con.sql(sql)
    if sorted(rel.columns) != cols:
        return False, len(a), 0, [cols, sorted(rel.columns)]
    rows = rel.fetchall()
    order = [rel.columns.index(c) for c in cols]
    b = sorted((plain(tuple(r[i] for i in order)) for r in rows), key=repr)
    diff = [] if a == b else [("spark", x) for x in list(set(map(repr, a)) - set(map(repr, b)))[:3]] + [("sql", x) for x in list(set(map(repr, b)) - set(map(repr, a)))[:3]]
    return a == b, len(a), len(b), diff


def main(sf, names):
    import __spark_entry__ as e
    from sparkloom.runtime import session

    spark = session()
    spark.sparkContext.setLogLevel("ERROR")
    d = f"/root/testdata/{sf}"
    con = oracle(d)
    q, s = e.queries(), e.oracle_sql()
    for name in names or q:
        t = time.time()
        try:
            if name in s:
                print(name, *same(q[name](spark, d), con, s[name]), f"{time.time() - t:.1f} s", flush=True)
            else:
                print(name, "rows only", q[name](spark, d).count(), f"{time.time() - t:.1f} s", flush=True)
        except Exception as x:  # noqa: BLE001
            print(name, "ERROR", str(x)[:600], flush=True)


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2:])
