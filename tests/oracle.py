"""Compare a Spark result with DuckDB's answer as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    """A connection with the driver tables as views."""
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def bag(columns, rows):
    """Multiset of rows with columns in name order."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> list[str]:
    """What differs between a DataFrame and a SQL answer; empty when they agree."""
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} vs {sorted(names)}"]
    want = bag(names, result.fetchall())
    got = bag(df.columns, [tuple(r) for r in df.collect()])
    if want == got:
        return []
    missing, extra = want - got, got - want
    return [f"rows {sum(got.values())} vs {sum(want.values())}"] + [
        f"only SQL: {r}" for r in list(missing)[:3]
    ] + [f"only Spark: {r}" for r in list(extra)[:3]]
