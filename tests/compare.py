"""Run registered queries next to their SQL on DuckDB and compare whole results."""

from __future__ import annotations

import glob
import os
import sys
import time
from collections import Counter

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
import __spark_entry__ as registry  # noqa: E402


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _family(value: object) -> str:
    return type(value).__name__


def compare(spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf: str) -> str:
    """Empty text when columns, types and all rows agree, else what differs."""
    df = registry.queries()[name](spark, sf)
    got_cols = sorted(df.columns)
    got = Counter(tuple(r) for r in df.select(*got_cols).collect())
    sql = registry.oracle_sql().get(name)
    if sql is None:
        return "" if got else "no rows"
    result = con.execute(sql)
    cols = [d[0] for d in result.description]
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    want_cols = [cols[i] for i in order]
    if want_cols != got_cols:
        return f"columns {got_cols} != {want_cols}"
    want = Counter(tuple(r[i] for i in order) for r in result.fetchall())
    if got != want:
        extra, missing = list((got - want).items())[:2], list((want - got).items())[:2]
        return f"{sum(got.values())} rows, expected {sum(want.values())}; extra {extra}; missing {missing}"
    kinds = {}
    for rows in (got, want):
        for r in rows:
            for c, v in zip(got_cols, r):
                if v is not None:
                    kinds.setdefault(c, set()).add(_family(v))
    mixed = {c: k for c, k in kinds.items() if len(k) > 1}
    return f"types differ: {mixed}" if mixed else ""


if __name__ == "__main__":
    from conftest import build_session

    sf = os.environ.get("SF_DIR", "/root/testdata/sf0.01")
    names = sys.argv[1:] or list(registry.queries())
    session, con = build_session(), connect(sf)
    for n in names:
        start = time.time()
        try:
            problem = compare(session, con, n, sf)
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:700]}"
        print(f"{'ok ' if not problem else 'BAD'} {n} {time.time() - start:.1f}s {problem}", flush=True)
