"""Wide-column tables as rows ``(row_key, family, qualifier, ts, value)``.

A cell table is stored sorted by ``row_key`` (see ``write_cells``), so that key and
prefix predicates prune files and row groups through their min/max statistics.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.encoding import base64_text, column_family, column_qualifier
from tallyloom.operators.mapreduce import grouped_lists

CELL_COLUMNS = ["row_key", "family", "qualifier", "ts", "value"]
CELL_SCHEMA = "row_key string, family string, qualifier string, ts bigint, value string"

REST_SCHEMA = (
    "Row array<struct<key: string, Cell: array<struct<column: string, timestamp: bigint, `$`: string>>>>"
)


def scan(spark: SparkSession, path: str) -> DataFrame:
    """All cells of a stored table."""
    return spark.read.schema(CELL_SCHEMA).parquet(path)


def write_cells(cells: DataFrame, path: str, mode: str = "append") -> None:
    """Store cells in row-key order; a row key with many cells spans several files."""
    order = ["row_key", "family", "qualifier", "ts"]
    (
        cells.select(*CELL_COLUMNS)
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .write.mode(mode)
        .parquet(path)
    )


def key_range(cells: DataFrame, row_start: str | None = None, row_stop: str | None = None) -> DataFrame:
    """Cells with ``row_start <= row_key < row_stop`` in byte order."""
    out = cells
    if row_start is not None:
        out = out.where(F.col("row_key") >= row_start)
    if row_stop is not None:
        out = out.where(F.col("row_key") < row_stop)
    return out


def key_matches(pattern: str) -> Column:
    """Equality, or a prefix test if the pattern ends in ``*``."""
    key = F.col("row_key")
    return key.startswith(pattern[:-1]) if pattern.endswith("*") else key == pattern


def latest(cells: DataFrame, tie_break: Column | None = None) -> DataFrame:
    """Last version of each cell; ``tie_break`` orders versions of equal time."""
    version = F.col("ts") if tie_break is None else F.struct("ts", tie_break)
    newest = F.max_by(F.struct("ts", "value"), version)
    return (
        cells.groupBy("row_key", "family", "qualifier")
        .agg(newest.alias("newest"))
        .select("row_key", "family", "qualifier", "newest.ts", "newest.value")
    )


def get_rows(
    cells: DataFrame,
    row_keys: str | Sequence[str],
    family: str = "",
    tie_break: Column | None = None,
) -> DataFrame:
    """Last versions of the cells of some row keys.

    ``row_keys`` is a list, or a text of keys divided by ``/``; each may end in
    ``*``. Keys that match twice are read once, as all patterns form one filter
    over one scan. No match gives no rows.
    """
    patterns = row_keys.split("/") if isinstance(row_keys, str) else list(row_keys)
    exact = [p for p in patterns if not p.endswith("*")]
    wanted = F.col("row_key").isin(exact) if exact else F.lit(False)
    for pattern in patterns:
        if pattern.endswith("*"):
            wanted = wanted | key_matches(pattern)
    out = cells.where(wanted)
    if family:
        out = out.where(F.col("family") == family)
    return latest(out, tie_break)


def row_columns(cells: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per row key with a column ``family_qualifier`` per named ``family:qualifier``.

    ``cells`` holds one version per cell. Only the named cells are aggregated, so a row of
    very many cells is no different from others; an absent cell is null.
    """
    named = F.concat_ws(":", "family", "qualifier")
    values = [
        F.max(F.when(named == name, F.col("value"))).alias(name.replace(":", "_")) for name in columns
    ]
    return cells.groupBy("row_key").agg(*values)


def row_map(cells: DataFrame, max_cells: int = 100_000) -> DataFrame:
    """``(row_key, chunk, row)`` with maps ``family:qualifier -> value`` in name order.

    ``cells`` holds one version per cell. A row of more than ``max_cells`` cells is
    split over several chunks, in order (see ``grouped_lists``).
    """
    entry = F.struct(F.concat_ws(":", "family", "qualifier").alias("key"), F.col("value"))
    lists = grouped_lists(cells.select("row_key", entry.alias("item")), max_cells)
    return lists.select(
        F.col("key").alias("row_key"), "chunk", F.map_from_entries("values").alias("row")
    )


def nested_rows(cells: DataFrame, max_cells: int = 100_000) -> DataFrame:
    """Decoded row shape ``{key, chunk, row: [{family, qual, value, timestamp}]}``, in order."""
    cell = F.struct(
        "family", F.col("qualifier").alias("qual"), "value", F.col("ts").alias("timestamp")
    )
    lists = grouped_lists(cells.select("row_key", cell.alias("item")), max_cells)
    return lists.select("key", "chunk", F.col("values").alias("row"))


def decode_rest(responses: DataFrame, body: str = "body") -> DataFrame:
    """Cells of REST answers: nested JSON with Base64 keys, columns and values."""
    rows = responses.select(F.inline(F.from_json(body, REST_SCHEMA)["Row"]))
    flat = rows.select("key", F.inline("Cell"))
    name = base64_text(F.col("column"))
    return flat.select(
        base64_text(F.col("key")).alias("row_key"),
        column_family(name).alias("family"),
        column_qualifier(name).alias("qualifier"),
        F.col("timestamp").alias("ts"),
        base64_text(F.col("`$`")).alias("value"),
    )


def counter_cells(counts: DataFrame, key: str, qualifier: str, n: str, family: str = "mentions") -> DataFrame:
    """Counters as cells: row = key, qualifier = its second key, value = text of n."""
    return counts.select(
        F.col(key).alias("row_key"),
        F.lit(family).alias("family"),
        F.col(qualifier).alias("qualifier"),
        F.unix_millis(F.current_timestamp()).alias("ts"),
        F.col(n).cast("string").alias("value"),
    )


def put_cells(spark: SparkSession, rows: Sequence[tuple[str, str, str, int, str]]) -> DataFrame:
    """Cells given as literals."""
    return spark.createDataFrame(list(rows), CELL_SCHEMA)


def delete_rows(cells: DataFrame, row_keys: DataFrame) -> DataFrame:
    """Cells without the rows named in ``row_keys``; see ``delete_stored``."""
    return cells.join(row_keys.select("row_key"), "row_key", "left_anti")


def delete_stored(spark: SparkSession, path: str, row_keys: DataFrame, target: str) -> DataFrame:
    """Store the table in ``path`` without some rows as a new version in ``target``."""
    write_cells(delete_rows(scan(spark, path), row_keys), target, "overwrite")
    return scan(spark, target)
