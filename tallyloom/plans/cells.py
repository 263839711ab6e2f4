"""Wide-column reads, versions, decode and pivots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.pivot import axis_labels, cell_pivot
from tallyloom.session import scratch_dir, stored_table
from tallyloom.sources import cells
from tallyloom.sources.tables import EVENT_TYPES, customer_cells, event_cells, table


def q_cells_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.scan(spark, _stored_cells(spark, sf_dir))


def _stored_cells(spark: SparkSession, sf_dir: str) -> str:
    """Path of the customers' cells as a sorted table, written once per session and input."""
    write = lambda path: cells.write_cells(customer_cells(spark, sf_dir), path)
    return stored_table(spark, "cells", f"{sf_dir}/customer.parquet", write)


def q_cells_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cells.scan(spark, _stored_cells(spark, sf_dir))
    return cells.key_range(rows, "Customer#000000100", "Customer#000000200")


def q_cells_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cells.get_rows(cells.scan(spark, _stored_cells(spark, sf_dir)), "Customer#000000007")
    return cells.row_columns(found, ["info:nationkey", "info:segment", "acct:balance"])


def q_cells_glob(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.get_rows(cells.scan(spark, _stored_cells(spark, sf_dir)), "Customer#00000001*", "info")


def q_cells_multi_get(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = "Customer#000000012/Customer#00000001*/Customer#000000099"
    return cells.get_rows(cells.scan(spark, _stored_cells(spark, sf_dir)), keys)


def q_cells_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells.latest(event_cells(spark, sf_dir), F.col("event_id"))


def q_cells_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cells.nested_rows(cells.latest(customer_cells(spark, sf_dir)), 2)
    shown = F.transform(
        "row", lambda c: F.concat_ws(":", c["family"], c["qual"], c["value"], c["timestamp"])
    )
    return rows.select("key", "chunk", F.array_join(shown, ";").alias("cells"))


def _rest_cell(name: str, ts: int, value: Column) -> Column:
    return F.struct(
        F.base64(F.lit(name).cast("binary")).alias("column"),
        F.lit(ts).cast("bigint").alias("timestamp"),
        F.base64(value.cast("binary")).alias("$"),
    )


def q_cells_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    row_cells = F.array(
        _rest_cell("info:segment", 2, F.col("c_mktsegment")),
        _rest_cell("info:note:text", 3, F.concat_ws(":", "c_nationkey", "c_mktsegment")),
    )
    row = F.struct(F.base64(F.col("c_name").cast("binary")).alias("key"), row_cells.alias("Cell"))
    bodies = table(spark, sf_dir, "customer").select(
        F.to_json(F.struct(F.array(row).alias("Row"))).alias("body")
    )
    return cells.decode_rest(bodies)


def q_cells_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    overdrawn = table(spark, sf_dir, "customer").where(F.col("c_acctbal") < 0)
    keys = overdrawn.select(F.col("c_name").alias("row_key"))
    path = _stored_cells(spark, sf_dir)
    return cells.delete_stored(spark, path, keys, scratch_dir(spark, "cells-deleted"))


def q_cell_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest = cells.latest(event_cells(spark, sf_dir), F.col("event_id"))
    return cell_pivot(newest, EVENT_TYPES, family="value")


def q_axis_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return axis_labels(event_cells(spark, sf_dir))


QUERIES = {
    "cells_scan": q_cells_scan,
    "cells_range": q_cells_range,
    "cells_get": q_cells_get,
    "cells_glob": q_cells_glob,
    "cells_multi_get": q_cells_multi_get,
    "cells_latest": q_cells_latest,
    "cells_nested": q_cells_nested,
    "cells_decode": q_cells_decode,
    "cells_delete": q_cells_delete,
    "cell_pivot": q_cell_pivot,
    "axis_labels": q_axis_labels,
}

_BALANCE = "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR)"

_CELLS = f"""
    SELECT c_name AS row_key, 'info' AS family, 'nationkey' AS qualifier,
           CAST(1 AS BIGINT) AS ts, CAST(c_nationkey AS VARCHAR) AS value FROM customer
    UNION ALL
    SELECT c_name, 'info', 'segment', CAST(1 AS BIGINT), lower(c_mktsegment) FROM customer
    UNION ALL
    SELECT c_name, 'info', 'segment', CAST(2 AS BIGINT), c_mktsegment FROM customer
    UNION ALL
    SELECT c_name, 'acct', 'balance', CAST(1 AS BIGINT), {_BALANCE} FROM customer
"""

_LATEST = f"""
    SELECT row_key, family, qualifier, ts, value FROM ({_CELLS})
    WHERE NOT (qualifier = 'segment' AND ts = 1)
"""

_EVENT_LATEST = """
    SELECT row_key, family, qualifier, ts, value
    FROM (SELECT CAST(user_id AS VARCHAR) AS row_key, 'value' AS family,
                 event_type AS qualifier, epoch_us(ts) AS ts,
                 CAST(CAST(value AS DECIMAL(18,2)) AS VARCHAR) AS value,
                 row_number() OVER (PARTITION BY user_id, event_type
                                    ORDER BY ts DESC, event_id DESC) AS rn
          FROM events)
    WHERE rn = 1
"""

ORACLES = {
    "cells_scan": _CELLS,
    "cells_range": f"""
        SELECT * FROM ({_CELLS})
        WHERE row_key >= 'Customer#000000100' AND row_key < 'Customer#000000200'
    """,
    "cells_get": f"""
        SELECT c_name AS row_key, CAST(c_nationkey AS VARCHAR) AS info_nationkey,
               c_mktsegment AS info_segment, {_BALANCE} AS acct_balance
        FROM customer WHERE c_name = 'Customer#000000007'
    """,
    "cells_glob": f"""
        SELECT * FROM ({_LATEST})
        WHERE starts_with(row_key, 'Customer#00000001') AND family = 'info'
    """,
    "cells_multi_get": f"""
        SELECT * FROM ({_LATEST})
        WHERE starts_with(row_key, 'Customer#00000001')
           OR row_key IN ('Customer#000000012', 'Customer#000000099')
    """,
    "cells_latest": _EVENT_LATEST,
    "cells_nested": f"""
        SELECT row_key AS key, CAST((rn - 1) // 2 AS INTEGER) AS chunk,
               string_agg(family || ':' || qualifier || ':' || value || ':' || ts, ';'
                          ORDER BY family, qualifier) AS cells
        FROM (SELECT *, row_number() OVER (PARTITION BY row_key ORDER BY family, qualifier) AS rn
              FROM ({_LATEST}))
        GROUP BY row_key, chunk
    """,
    "cells_decode": """
        SELECT c_name AS row_key, 'info' AS family, 'segment' AS qualifier,
               CAST(2 AS BIGINT) AS ts, c_mktsegment AS value FROM customer
        UNION ALL
        SELECT c_name, 'info', 'note:text', CAST(3 AS BIGINT),
               c_nationkey || ':' || c_mktsegment FROM customer
    """,
    "cells_delete": f"""
        SELECT * FROM ({_CELLS})
        WHERE row_key NOT IN (SELECT c_name FROM customer WHERE c_acctbal < 0)
    """,
    "cell_pivot": "SELECT row_key, "
    + ", ".join(
        f"max(CASE WHEN qualifier = '{name}' THEN CAST(value AS DOUBLE) END) AS \"{name}\""
        for name in EVENT_TYPES
    )
    + f" FROM ({_EVENT_LATEST}) GROUP BY row_key",
    "axis_labels": "SELECT DISTINCT event_type AS qualifier FROM events ORDER BY 1",
}
