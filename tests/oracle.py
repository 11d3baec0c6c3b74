"""Compare registered queries with their DuckDB statements."""

from __future__ import annotations

import datetime
import math
import time
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return sorted(plain, key=lambda r: tuple((v is None, str(v)) for v in r))


def compare(spark, con, query, sql, sf_dir):
    """None when equal, else a short description."""
    started = time.time()
    df = query(spark, sf_dir)
    mine = [tuple(r) for r in df.collect()]
    took = time.time() - started
    rel = con.execute(sql)
    names = [c[0] for c in rel.description]
    theirs = rel.fetchall()
    if sorted(df.columns) != sorted(names):
        return took, len(mine), f"columns {sorted(df.columns)} != {sorted(names)}"
    a, b = _rows(df.columns, mine), _rows(names, theirs)
    if len(a) != len(b):
        return took, len(mine), f"{len(a)} rows != {len(b)}; e.g. {list(set(a) - set(b))[:2]} / {list(set(b) - set(a))[:2]}"
    for left, right in zip(a, b):
        if left != right:
            return took, len(mine), f"{sorted(names)}: {left} != {right}"
        if [type(v) for v in left] != [type(v) for v in right]:
            return took, len(mine), f"types {left} {right}"
    return took, len(mine), None
