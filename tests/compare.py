"""Compare a Spark result with SQL run by DuckDB on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6) + 0.0
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(normal(r[i]) for i in order) for r in rows), key=repr)


def differences(spark_df, con, sql: str) -> list[str]:
    """What differs; an empty list means the two results agree."""
    got = spark_df.collect()
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    if sorted(columns) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} and {sorted(columns)}"]
    mine, theirs = rows_of(spark_df.columns, got), rows_of(columns, cur.fetchall())
    if len(mine) != len(theirs):
        extra, lacking = set(mine) - set(theirs), set(theirs) - set(mine)
        return [f"{len(mine)} and {len(theirs)} rows", f"only Spark {list(extra)[:3]}", f"only SQL {list(lacking)[:3]}"]
    return [f"{a} and {b}" for a, b in zip(mine, theirs) if a != b][:5]
