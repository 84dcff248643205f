"""Runs a registered query and its check SQL, and compares whole results."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, bool) or v is None:
        return str(v)
    return str(v)


def rows_of_spark(df):
    names = sorted(df.columns)
    return names, sorted(tuple(_cell(r[n]) for n in names) for r in df.collect())


def rows_of_duck(con, sql):
    cur = con.execute(sql)
    given = [d[0] for d in cur.description]
    order = sorted(range(len(given)), key=lambda i: given[i])
    return sorted(given), sorted(tuple(_cell(r[i]) for i in order) for r in cur.fetchall())


def difference(got, want):
    """None when equal, else a short description."""
    (gn, gr), (wn, wr) = got, want
    if gn != wn:
        return f"columns {gn} != {wn}"
    if len(gr) != len(wr):
        return f"{len(gr)} rows, expected {len(wr)}"
    bad = [(g, w) for g, w in zip(gr, wr) if g != w]
    return f"{len(bad)} rows differ, e.g. {str(bad[0])[:1500]}" if bad else None
