"""Rows of a query against rows of its SQL."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events "
    "documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Messages about what differs; empty if both give the same rows."""
    got = df.collect()
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    want = result.fetchall()
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} and {sorted(names)}"]
    order = sorted(names)
    mine = sorted((tuple(r[c] for c in order) for r in got), key=repr)
    theirs = sorted((tuple(r[names.index(c)] for c in order) for r in want), key=repr)
    if len(mine) != len(theirs):
        return [f"{len(mine)} rows and {len(theirs)}"]
    return [f"{order}: {a} and {b}" for a, b in zip(mine, theirs) if a != b][:3]
