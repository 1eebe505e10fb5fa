"""Compare registered queries with their SQL twins: row count, column types, sorted values."""

from __future__ import annotations

import datetime as dt
import sys
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _value(v):
    if isinstance(v, float):
        return round(v, 9)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_value(r[i]) for i in order) for r in rows)


def compare(spark, con, name, fn, sql, sf_dir) -> tuple[bool, str]:
    t0 = time.time()
    df = fn(spark, sf_dir)
    got = rows_of(df.columns, df.collect())
    took = time.time() - t0
    if sql is None:
        return sum(got.values()) > 0, f"{sum(got.values())} rows, no SQL twin, {took:.2f}s"
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    want = rows_of(columns, cur.fetchall())
    if sorted(columns) != sorted(df.columns):
        return False, f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = {d[0]: str(d[1]) for d in cur.description}
    spark_kinds = dict(df.dtypes)
    names = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}
    bad = {c: (spark_kinds[c], kinds[c]) for c in columns if names.get(spark_kinds[c]) != kinds[c]}
    if bad:
        return False, f"types {bad}"
    if got != want:
        return False, f"{sum(got.values())} rows vs {sum(want.values())}; only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
    return sum(got.values()) > 0, f"{sum(got.values())} rows, {took:.2f}s"


if __name__ == "__main__":
    sys.path.insert(0, "/root/repo")
    from __spark_entry__ import oracle_sql, queries

    from tidewater.session import build_session

    sf = sys.argv[1]
    only = sys.argv[2:]
    spark = build_session(master="local[8]", **{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf)
    failed = []
    for name, fn in queries().items():
        if only and name not in only:
            continue
        try:
            ok, note = compare(spark, con, name, fn, oracle_sql().get(name), sf)
        except Exception as e:
            ok, note = False, f"{type(e).__name__}: {str(e)[:600]}"
        if not ok:
            failed.append(name)
        print("ok  " if ok else "FAIL", name, note, flush=True)
    print("failed:", failed)
