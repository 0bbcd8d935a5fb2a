"""Run a query and its SQL side by side and compare rows as multisets."""

import datetime
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        path = Path(folder) / f"{t}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else float(repr(value + 0.0))
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(plain(r[i]) for i in order) for r in rows)


def kinds(counter, width):
    out = [set() for _ in range(width)]
    for row in counter:
        for i, v in enumerate(row):
            if v is not None:
                out[i].add(type(v).__name__)
    return out


def difference(spark_df, con, sql):
    """None when equal, else a short description."""
    a_cols, a = rows_of(spark_df.columns, spark_df.collect())
    cur = con.execute(sql)
    b_cols, b = rows_of([d[0] for d in cur.description], cur.fetchall())
    if a_cols != b_cols:
        return f"columns {a_cols} != {b_cols}"
    if a != b:
        only_a, only_b = a - b, b - a
        return (f"{sum(only_a.values())} of {sum(a.values())} rows only in Spark, {sum(only_b.values())} of "
                f"{sum(b.values())} only in SQL\n  {sorted(only_a, key=repr)[:2]}\n  {sorted(only_b, key=repr)[:2]}")
    if kinds(a, len(a_cols)) != kinds(b, len(b_cols)):
        return f"types {list(zip(a_cols, kinds(a, len(a_cols)), kinds(b, len(b_cols))))}"
    return None
