"""Spark results against DuckDB over the same tables."""

from __future__ import annotations

import math
import os

import duckdb


def plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "asDict") or isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((plain(a), plain(b)) for a, b in v.items()))
    return v


def duck(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for f in os.listdir(sf_dir):
        path = f"{sf_dir}/{f}" + ("/*.parquet" if os.path.isdir(f"{sf_dir}/{f}") else "")
        con.execute(f"CREATE VIEW {f.split('.')[0]} AS SELECT * FROM '{path}'")
    found = con.execute(sql)
    names = [c[0] for c in found.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    names = sorted(df.columns)
    return names, sorted((tuple(plain(x) for x in r) for r in df.select(*names).collect()), key=repr)
