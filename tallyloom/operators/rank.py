"""Global rank of integers by counting, without a global sort of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Values are cut into digits of at most this many bits. A window over the children
# of one prefix then has at most 2**DIGIT_BITS rows, whatever the data.
DIGIT_BITS = 21

# A value that occurs often is written out in runs of RUN_ROWS positions.
RUN_ROWS = 1 << 20
STEP_ROWS = 1 << 10


def bead_sort(rows: DataFrame, value: str, max_value: int | None = None) -> DataFrame:
    """Rows ``(pos, value)``: ascending 0-based rank of every value of at least 1.

    Values below 1 hold no bead: they take up the first positions but have no
    row of their own. Nulls are ignored. Equal values are interchangeable, so it
    is enough to count each value, add up the counts below it and write each
    value out once per position.

    ``max_value`` is an optional bound on the values; a lower bound needs fewer
    levels. Values above it raise an error.
    """
    bits = _value_bits(rows, value, max_value)
    x = F.col(value).cast("bigint")
    if max_value is not None:
        message = F.lit(f"value above max_value {max_value}")
        x = F.when(x <= max_value, x).when(x.isNotNull(), F.raise_error(message).cast("bigint"))
    counts = (
        rows.select(F.greatest(x, F.lit(0)).alias("value"))
        .where(x.isNotNull())
        .groupBy("value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return _write_out(_starts(counts, bits).where(F.col("value") >= 1))


def _value_bits(rows: DataFrame, value: str, max_value: int | None) -> int:
    if max_value is not None:
        return max(int(max_value), 1).bit_length()
    data_type = rows.schema[value].dataType
    known = {T.ByteType: 7, T.ShortType: 15, T.IntegerType: 31, T.LongType: 63}
    if type(data_type) not in known:
        raise ValueError(f"bead_sort needs an integer column, not {data_type.simpleString()}")
    return known[type(data_type)]


def _starts(counts: DataFrame, bits: int) -> DataFrame:
    """Rows ``(value, n, start)``: ``start`` is the number of smaller values.

    Works down a digit tree: the total of every prefix, then the totals of the
    smaller siblings under the same parent, added to the parent's own start.
    """
    levels = -(-bits // DIGIT_BITS)
    digit = -(-bits // levels)
    totals = [counts]
    for _ in range(levels - 1):
        prefix = F.shiftright("value", digit).alias("value")
        totals.append(totals[-1].groupBy(prefix).agg(F.sum("n").alias("n")))
    top = totals.pop().withColumn("parent", F.lit(0).cast("bigint"))
    started = _add_sibling_totals(top, F.lit(0).cast("bigint"))
    while totals:
        parents = started.select(F.col("value").alias("parent"), F.col("start").alias("base"))
        children = totals.pop().withColumn("parent", F.shiftright("value", digit))
        started = _add_sibling_totals(children.join(parents, "parent"), F.col("base"))
    return started


def _add_sibling_totals(level: DataFrame, base: Column) -> DataFrame:
    smaller = (
        Window.partitionBy("parent")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("n").over(smaller), F.lit(0).cast("bigint"))
    return level.select("value", "n", (base + before).alias("start"))


def _write_out(started: DataFrame) -> DataFrame:
    """One row per position; long runs are split and spread before they grow."""

    def pieces(size: int) -> Column:
        last = F.col("start") + F.col("n") - 1
        return F.explode(F.sequence(F.col("start"), last, F.lit(size).cast("bigint")))

    def cut(frame: DataFrame, size: int) -> DataFrame:
        end = F.col("start") + F.col("n")
        return frame.select("value", end.alias("end"), pieces(size).alias("start")).select(
            "value", "start", F.least(F.col("end") - F.col("start"), F.lit(size)).alias("n")
        )

    runs = cut(started, RUN_ROWS).repartition("value", "start")
    steps = cut(runs, STEP_ROWS)
    return steps.select(pieces(1).alias("pos"), "value")

