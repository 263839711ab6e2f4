"""Stored cuboids of an OLAP cube: few are kept, every slice is answered from one of them."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.cube import CubeSpec, olap_slice

Dims = frozenset[str]


def choose_cuboids(sizes: Mapping[Dims, int], extra: int) -> list[Dims]:
    """The finest cuboid and up to ``extra`` more, chosen greedily by what they save.

    A cuboid costs the rows of the smallest chosen one that holds its dimensions. The
    cuboid that lowers the sum of all costs most comes next; none is added that saves nothing.
    """
    finest = max(sizes, key=len)
    cost = {dims: sizes[finest] for dims in sizes}
    chosen = [finest]

    def saved(dims: Dims) -> int:
        return sum(max(0, cost[part] - sizes[dims]) for part in sizes if part <= dims)

    for _ in range(extra):
        # Ties go to fewer dimensions, then by name.
        best = min(sizes, key=lambda dims: (-saved(dims), len(dims), sorted(dims)))
        if saved(best) <= 0:
            break
        chosen.append(best)
        for part in sizes:
            if part <= best:
                cost[part] = min(cost[part], sizes[best])
    return chosen


@dataclass(frozen=True)
class CuboidStore:
    """Sums of facts for some sets of dimensions, each in a table below ``path``.

    Sums of exact types (whole numbers, decimals) are those of the facts. A slice reads
    the smallest stored cuboid that has its dimensions, never the facts.
    """

    path: str
    spec: CubeSpec

    def _folder(self, dims: Iterable[str]) -> str:
        held = set(dims)
        return f"{self.path}/c-" + "-".join(str(i) for i, d in enumerate(self.spec.dimensions) if d in held)

    def build(self, facts: DataFrame, extra: int = 3) -> list[Dims]:
        """Read the facts once, then sum up each chosen cuboid from the smallest one above it.

        The sizes that guide the choice are estimates (one sketch per set of dimensions,
        all in one pass over the finest cuboid); the sums are exact.
        """
        spark, dims = facts.sparkSession, list(self.spec.dimensions)
        self._write(facts, dims)
        finest = spark.read.parquet(self._folder(dims))
        sets = [frozenset(some) for n in range(len(dims) + 1) for some in combinations(dims, n)]
        sketches = [
            F.approx_count_distinct(F.struct(*[d for d in dims if d in some]) if some else F.lit(1)).alias(f"n{i}")
            for i, some in enumerate(sets)
        ]
        # A part has no more rows than the whole, whatever the sketches say.
        counted, whole = finest.agg(*sketches).first(), finest.count()
        sizes = {some: whole if len(some) == len(dims) else min(whole, counted[f"n{i}"]) for i, some in enumerate(sets)}
        chosen = choose_cuboids(sizes, extra)
        rows = [(sorted(chosen[0]), whole)]
        for some in sorted(chosen[1:], key=lambda c: (-sizes[c], -len(c))):
            above = self._smallest(rows, some)
            self._write(spark.read.parquet(self._folder(above)), [d for d in dims if d in some], summed=True)
            rows.append((sorted(some), spark.read.parquet(self._folder(some)).count()))
        listed = spark.createDataFrame(rows, "dims array<string>, n bigint")
        listed.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/chosen")
        return chosen

    def _write(self, source: DataFrame, dims: Sequence[str], summed: bool = False) -> None:
        sums = source.groupBy(*dims).agg(*[F.sum(m).alias(m) for m in self.spec.measures])
        if summed:
            sums = self._as_in(source, sums)
        # Sorted, so that the row groups of other members are skipped.
        ordered = sums.sortWithinPartitions(*dims) if dims else sums
        ordered.write.mode("overwrite").parquet(self._folder(dims))

    @staticmethod
    def _smallest(rows: Iterable[tuple[Sequence[str], int]], wanted: Iterable[str]) -> Sequence[str]:
        fits = [(n, len(dims), list(dims)) for dims, n in rows if set(wanted) <= set(dims)]
        return min(fits)[2]

    def slice(
        self, spark: SparkSession, axes: Sequence[str] = (), where: Mapping[str, object] | None = None
    ) -> DataFrame:
        """What ``olap_slice`` gives for the facts, from the smallest cuboid that holds it."""
        asked = {*axes, *(where or {})}
        unknown = asked - set(self.spec.dimensions)
        if unknown:
            raise ValueError(f"unknown dimensions {sorted(unknown)}")
        listed = [tuple(row) for row in spark.read.parquet(f"{self.path}/chosen").collect()]
        cuboid = spark.read.parquet(self._folder(self._smallest(listed, asked)))
        cells = olap_slice(cuboid, self.spec, axes, where)
        return self._as_in(cuboid, cells)

    def _as_in(self, cuboid: DataFrame, sums: DataFrame) -> DataFrame:
        """Sums of decimal sums are wider than the sums; give them the type of these."""
        return sums.withColumns({m: F.col(m).cast(cuboid.schema[m].dataType) for m in self.spec.measures})
