"""Line dedup by site-relative frequency.

Pages are grouped by host. A line is boilerplate of its host if the share of the host's
pages that contain it exceeds a ratio. Lines travel as two 64-bit hashes and are counted
before the shuffle. A host has at most (lines per page / ratio) boilerplate lines, so
its list is short however many pages it has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.session import stored

MAX_RATIO = 0.02
# One page says nothing about what a host repeats.
MIN_PAGES = 2


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def line_key(line: Column) -> Column:
    """128 bits of a line; equal keys are taken as equal lines."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def boilerplate(
    pages: DataFrame,
    host: str = "source",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """(host, drop): keys of the lines on over ``max_ratio`` of the host's pages.

    A line also has to be on ``min_pages`` pages. A line counts once per page. Blank lines are never boilerplate. A null
    host is a host of its own, written as a null.
    """
    rows = pages.select(F.col(host).alias("host"), F.coalesce("text", F.lit("")).alias("text"))
    totals = rows.groupBy("host").agg(F.count("*").alias("pages"))
    counted = (
        rows.select("host", F.explode(F.array_distinct(lines_of(F.col("text")))).alias("line"))
        .filter(F.trim("line") != "")
        .select("host", line_key(F.col("line")).alias("line"))
        .groupBy("host", "line")
        .agg(F.count("*").alias("n"))
        .filter(F.col("n") >= min_pages)
    )
    frequent = counted.join(totals, counted["host"].eqNullSafe(totals["host"])).filter(
        F.col("n") / F.col("pages") > max_ratio
    )
    return frequent.groupBy(counted["host"].alias("host")).agg(
        F.collect_list("line").alias("drop")
    )


def without_boilerplate(
    pages: DataFrame,
    host: str = "source",
    max_ratio: float = MAX_RATIO,
    min_pages: int = MIN_PAGES,
) -> DataFrame:
    """``pages`` with the boilerplate lines of their host taken out of ``text``.

    Two columns are added: ``n_lines`` (before) and ``n_removed``; columns of these names
    are replaced. Kept lines stay in order, joined by line ends. A page of nothing but
    boilerplate keeps its row with an empty text. A null text stays null and has one
    line. Repeated rows count as pages of their own. Other columns may have any names. An
    empty table gives no rows.
    """
    drops = stored(boilerplate(pages, host, max_ratio, min_pages), "boilerplate").select(
        F.col("host").alias("of"), "drop"
    )
    names = [n for n in pages.columns if n not in ("n_lines", "n_removed")]
    # The caller's row travels as one value, so that its columns cannot meet those made here.
    rows = pages.select(F.struct(*[F.col(f"`{n}`") for n in names]).alias("row"), F.col(host).alias("host"))
    rows = rows.join(drops, F.col("host").eqNullSafe(F.col("of")), "left")
    rows = rows.select("row", "drop", lines_of(F.coalesce("row.text", F.lit(""))).alias("lines"))
    kept = F.when(F.col("drop").isNull(), F.col("lines")).otherwise(
        F.filter("lines", lambda line: ~F.array_contains("drop", line_key(line)))
    )
    rows = rows.select("row", "lines", kept.alias("kept"))
    removed = F.size("lines") - F.size("kept")
    text = F.when(removed > 0, F.array_join("kept", "\n")).otherwise(F.col("row.text"))
    return rows.select(
        *[text.alias("text") if n == "text" else F.col("row").getField(n).alias(n) for n in names],
        F.size("lines").cast("long").alias("n_lines"),
        removed.cast("long").alias("n_removed"),
    )
