"""Compare a query with its SQL twin: same columns, same bag of rows."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

from tallyloom.sources.tables import TABLES


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def mismatch(spark_frame, connection, sql: str) -> str | None:
    """None if equal, else a short description."""
    relation = connection.execute(sql)
    sql_columns = [d[0] for d in relation.description]
    if sorted(spark_frame.columns) != sorted(sql_columns):
        return f"columns {sorted(spark_frame.columns)} against {sorted(sql_columns)}"
    ours = bag(spark_frame.columns, [tuple(row) for row in spark_frame.collect()])
    theirs = bag(sql_columns, relation.fetchall())
    if ours == theirs:
        return None if ours else "no rows at all"
    extra, absent = list((ours - theirs).items()), list((theirs - ours).items())
    return f"{len(extra)} extra, {len(absent)} absent; {extra[:2]} against {absent[:2]}"[:1500]
