"""Run registered queries beside their SQL in DuckDB and compare all values."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None:
        return None
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return 0.0 if v == 0 else v
    if isinstance(v, dict):
        return tuple(sorted((k, _plain(x)) for k, x in v.items()))
    if isinstance(v, (list, tuple)):
        return tuple(_plain(x) for x in v)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(r[i]) for i in order) for r in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def compare(con, df, sql: str) -> tuple[str, float]:
    """What differs, empty if nothing does, and the seconds spent outside Spark."""
    got = df.collect()
    began = time.time()
    return _difference(con, df.columns, got, sql), time.time() - began


def _difference(con, columns, got, sql: str) -> str:
    names, ours = _rows(columns, [list(r) for r in got])
    cur = con.execute(sql)
    sql_names, theirs = _rows([d[0] for d in cur.description], cur.fetchall())
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}"
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(bad)} of {len(ours)} rows differ, first {bad[0]}" if bad else ""
