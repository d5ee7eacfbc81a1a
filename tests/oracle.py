"""Compare a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

import datetime as dt
import decimal
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def _plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return repr(round(value, 6) + 0.0)
    if isinstance(value, bool):
        return value
    if isinstance(value, (dt.datetime, dt.date)):
        return value.isoformat()
    return value


def _kind(value):
    return "number" if isinstance(value, float) else type(value).__name__


def _rows(names, rows):
    at = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in at) for row in rows)


def difference(spark_df, db, sql: str) -> str | None:
    """What differs, or None."""
    found = db.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(names)}"
    wanted = _rows(names, found.fetchall())
    got = _rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if wanted == got:
        return None
    extra, missing = got - wanted, wanted - got
    return (
        f"{sum(got.values())} rows, wanted {sum(wanted.values())};"
        f" extra {list(extra)[:2]}, missing {list(missing)[:2]}"
    )
