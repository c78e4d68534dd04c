"""Compare a registered query with its SQL text on DuckDB."""

from __future__ import annotations

import datetime as dt
import math
import os
from collections import Counter
from decimal import Decimal

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, int):
        return float(value) if abs(value) < 2**53 else value
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def as_bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), Counter(tuple(plain(row[i]) for i in order) for row in rows)


def compare(df, con, sql):
    """Empty text when both agree, else what differs."""
    cursor = con.execute(sql)
    expected_columns, expected = as_bag([d[0] for d in cursor.description], cursor.fetchall())
    columns, found = as_bag(df.columns, [tuple(r) for r in df.collect()])
    if columns != expected_columns:
        return f"columns {columns} != {expected_columns}"
    if found != expected:
        missing, surplus = expected - found, found - expected
        return f"{sum(missing.values())} rows missing, {sum(surplus.values())} surplus: {list(missing)[:2]} / {list(surplus)[:2]}"
    return ""
