"""Run a registered query and its DuckDB oracle and compare every value."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def compare(spark_df, con, sql: str) -> tuple[str | None, int]:
    """``(problem or None, rows)``."""
    result = con.sql(sql)
    names = sorted(result.columns)
    want = result.fetchall()
    order = [result.columns.index(n) for n in names]
    want = [tuple(_plain(row[i]) for i in order) for row in want]
    if sorted(spark_df.columns) != names:
        return f"columns {sorted(spark_df.columns)} != {names}", len(want)
    got = [tuple(_plain(v) for v in row) for row in spark_df.select(*names).collect()]
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}", len(want)
    def key(row):
        return tuple((v is None, str(v)) for v in row)

    got, want = sorted(got, key=key), sorted(want, key=key)
    for a, b in zip(got, want):
        for name, x, y in zip(names, a, b):
            if x != y or type(x) is not type(y):
                return f"{name}: spark {x!r} != oracle {y!r} in {a[:6]} / {b[:6]}", len(want)
    return None, len(want)
