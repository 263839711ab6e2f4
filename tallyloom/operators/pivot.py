"""Chart tables: one row per key, one column per qualifier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def axis_labels(cells: DataFrame) -> DataFrame:
    """Distinct qualifiers in order."""
    return cells.select("qualifier").distinct().orderBy("qualifier")


def cell_pivot(
    cells: DataFrame,
    labels: Sequence[str] | None = None,
    lenient: bool = False,
    family: str | None = None,
) -> DataFrame:
    """Values as numbers, aligned by qualifier; a missing point is null.

    ``cells`` holds one version per cell. A chart is of one family: name it where the cells
    are of several. Should a row still have a qualifier twice, the largest number is shown.
    With ``labels`` the columns are fixed and
    the plan is one aggregation; without, Spark first reads the distinct qualifiers
    and refuses more than ``spark.sql.pivotMaxValues`` of them. Text that is no
    number raises an error under ANSI mode, or gives null if ``lenient``.
    """
    number = F.col("value").try_cast("double") if lenient else F.col("value").cast("double")
    shown = cells if family is None else cells.where(F.col("family") == family)
    points = shown.select("row_key", "qualifier", number.alias("number"))
    grouped = points.groupBy("row_key")
    pivoted = (
        grouped.pivot("qualifier") if labels is None else grouped.pivot("qualifier", list(labels))
    )
    return pivoted.agg(F.max("number"))
