"""Compare a Spark result with its SQL twin, row by row."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _norm(v):
    """Values compare exactly; only -0.0 and NaN are given one spelling."""
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else v + 0.0
    return v


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


def difference(spark_df, con, sql: str) -> str | None:
    """None if both agree, else what differs."""
    rel = con.sql(sql)
    if sorted(spark_df.columns) != sorted(rel.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(rel.columns)}"
    got = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    want = rows_of(rel.columns, rel.fetchall())
    if len(got) != len(want):
        return f"{len(got)} rows, expected {len(want)}"
    for g, w in zip(got, want):
        if g != w:
            return f"{str(g)[:300]} != {str(w)[:300]}"
    return None
