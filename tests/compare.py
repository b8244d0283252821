"""Order-insensitive comparison of a Spark result with the checking database."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def database(folder: str):
    base = duckdb.connect()
    for name in TABLES:
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return base


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(repr(value)) + 0.0
    if isinstance(value, decimal.Decimal):
        return ("decimal", str(value))
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(v) for v in row) for row in df.select(*[f"`{n}`" for n in names]).collect())


def database_rows(base, text):
    cursor = base.execute(text)
    found = [c[0] for c in cursor.description]
    order = sorted(range(len(found)), key=lambda i: found[i])
    rows = Counter(tuple(_plain(row[i]) for i in order) for row in cursor.fetchall())
    return [found[i] for i in order], [str(cursor.description[i][1]) for i in order], rows
