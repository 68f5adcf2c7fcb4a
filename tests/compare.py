"""Comparison of a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math
from pathlib import Path


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for p in sorted(Path(sf_dir).glob("*.parquet")):
        at = f"{p}/*.parquet" if p.is_dir() else str(p)
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{at}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)) or type(v).__name__ == "Decimal":
        return f"{float(v):.9g}"
    return str(v)


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in data)


def same(spark_df, con, sql: str) -> None:
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    assert sorted(spark_df.columns) == sorted(names)
    assert rows(spark_df.columns, spark_df.collect()) == rows(names, cur.fetchall())
