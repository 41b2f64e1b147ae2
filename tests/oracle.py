"""Compare a Spark result with DuckDB SQL over the same tables, as multisets of rows."""

from __future__ import annotations

import collections
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    return value


def rows(columns, data) -> collections.Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return collections.Counter(tuple(plain(row[i]) for i in order) for row in data)


def difference(spark, con, query, sql, sf_dir) -> str | None:
    """None if equal, else a short description."""
    df = query(spark, sf_dir)
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [c[0] for c in cur.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    want = rows(names, cur.fetchall())
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows, expected {sum(want.values())}; "
        f"extra {list((got - want).items())[:3]}; missing {list((want - got).items())[:3]}"
    )
