"""Compares a query with its SQL on one set of tables."""

from __future__ import annotations

import datetime as dt
import glob
import math
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet({sorted(glob.glob(path + '/*.parquet')) or [path]})")
    return con


def plain(value):
    if value is None:
        return ""
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    if isinstance(value, bool):
        return str(value)
    if hasattr(value, "normalize") and not isinstance(value, str):
        return f"{value:.6f}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark_frame, con, sql):
    """Rows of either side that the other has not, after columns are matched by name."""
    left = rows_of(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    cur = con.execute(sql)
    right = rows_of([d[0] for d in cur.description], cur.fetchall())
    assert left[0] == right[0], (left[0], right[0])
    from collections import Counter

    a, b = Counter(left[1]), Counter(right[1])
    return list((a - b).elements()), list((b - a).elements()), len(left[1])
