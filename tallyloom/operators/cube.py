"""OLAP cube over a fact table: an "All" member per dimension, summed measures."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CubeSpec:
    """Dimensions, sum measures and the label that stands for all members."""

    dimensions: Sequence[str]
    measures: Sequence[str]
    all_member: str = "All Types"
    types: Mapping[str, str] = field(default_factory=dict)


def with_day(facts: DataFrame, ts: str, day: str = "date_day") -> DataFrame:
    """ETL step: the day of a timestamp as a column of its own."""
    return facts.withColumn(day, F.to_date(ts))


def _finest(facts: DataFrame, spec: CubeSpec, dimensions: Sequence[str]) -> DataFrame:
    """Facts summed at the finest level that the request needs.

    Sums of sums are sums, so the copies that a cube or rollup makes of its input
    are copies of these totals, not of the facts.
    """
    return facts.groupBy(*dimensions).agg(*[F.sum(m).alias(m) for m in spec.measures])


def _labelled(grouped, spec: CubeSpec, dimensions: Sequence[str]) -> DataFrame:
    sums = [F.sum(m).alias(m) for m in spec.measures]
    flags = [F.grouping(d).alias(f"_all_{i}") for i, d in enumerate(dimensions)]
    members = [
        F.when(F.col(f"_all_{i}") == 1, F.lit(spec.all_member))
        .otherwise(F.col(d).cast("string"))
        .alias(d)
        for i, d in enumerate(dimensions)
    ]
    rest = [F.lit(spec.all_member).alias(d) for d in spec.dimensions if d not in dimensions]
    frame = grouped.agg(*sums, *flags).select(*members, *rest, *spec.measures)
    return frame.select(*spec.dimensions, *spec.measures)


def olap_cube(facts: DataFrame, spec: CubeSpec) -> DataFrame:
    """Every combination of member or "All" over every dimension."""
    dims = list(spec.dimensions)
    return _labelled(_finest(facts, spec, dims).cube(*dims), spec, dims)


def olap_rollup(facts: DataFrame, spec: CubeSpec, dimensions: Sequence[str]) -> DataFrame:
    """Subtotals along one path of dimensions; dimensions left out are "All"."""
    dims = list(dimensions)
    return _labelled(_finest(facts, spec, dims).rollup(*dims), spec, dims)


def olap_slice(
    facts: DataFrame,
    spec: CubeSpec,
    axes: Sequence[str] = (),
    where: Mapping[str, object] | None = None,
) -> DataFrame:
    """Cells for the members on ``axes`` under fixed members ``where``, the rest "All".

    Asks for just these cells, so the filter reaches the scan and nothing else
    of the cube is computed.
    """
    fixed = dict(where or {})
    unknown = (set(axes) | set(fixed)) - set(spec.dimensions)
    if unknown:
        raise ValueError(f"unknown dimensions {sorted(unknown)}")
    source = facts
    for dimension, member in fixed.items():
        source = source.where(F.col(dimension) == F.lit(member))
    shown = [d for d in spec.dimensions if d in axes or d in fixed]
    cells = source.groupBy(*shown).agg(*[F.sum(m).alias(m) for m in spec.measures])
    members = [
        (F.col(d).cast("string") if d in shown else F.lit(spec.all_member)).alias(d)
        for d in spec.dimensions
    ]
    return cells.select(*members, *spec.measures)
