"""Spark-vs-DuckDB result comparison used by the tests and the local check."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def norm(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "item"):
        return norm(v.item())
    return v


def rows(cols, data):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [tuple(norm(r[i]) for i in order) for r in data]


def compare(spark_cols, spark_rows, duck_cols, duck_rows) -> list[str]:
    """Empty list when equal (names, count, multiset of rows)."""
    msgs = []
    if sorted(spark_cols) != sorted(duck_cols):
        msgs.append(f"columns spark={sorted(spark_cols)} duck={sorted(duck_cols)}")
    if len(spark_rows) != len(duck_rows):
        msgs.append(f"rows spark={len(spark_rows)} duck={len(duck_rows)}")
    if not msgs:
        a, b = Counter(rows(spark_cols, spark_rows)), Counter(rows(duck_cols, duck_rows))
        if a != b:
            da, db = list((a - b).elements())[:3], list((b - a).elements())[:3]
            msgs.append(f"{sum((a - b).values())} rows differ; spark-only {da} duck-only {db}")
    return msgs
