"""Most similar neighbours of each person among those with an equal key."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.functions.text import char_set
from tallyloom.operators.topk import top_k_per_group
from tallyloom.session import stored

BLOCK_ROWS = 2048
OUTPUT_ROWS = 50_000


def similar_neighbours(
    persons: DataFrame,
    neighbours: DataFrame,
    on: str,
    name: str,
    neighbour_id: str,
    k: int = 2,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k neighbours with the same ``on`` that share most distinct characters.

    Both inputs have columns ``on`` and ``name``; ``neighbours`` also has the
    column ``neighbour_id``, whose order settles ties. The result is every
    persons row with ``neighbour_id``, ``score`` and ``rank``. A person whose key
    has no neighbour at all is an error, raised when the result is computed.

    Only a name's set of characters matters for the score. So persons shrink to
    their distinct sets per key, neighbours to the first k per set and key, and
    both are cut into blocks of sets of one size. Two blocks can share no more
    characters than the smaller size. Each block of persons is first scored
    against the key's block of largest sets; the k-th score found there rules out
    the blocks that cannot beat it, which never meet. Pairs of blocks that are
    left are scored as matrices; tasks return k rows per set, never the pairs.
    """
    letters = F.array_join(char_set(F.coalesce(F.col(name), F.lit(""))), "")
    people = persons.withColumn("_set", letters)
    no_key = F.raise_error(F.lit(f"person without {on}")).cast(persons.schema[on].dataType)
    wanted = people.select(F.coalesce(F.col(on), no_key).alias(on), "_set").distinct()
    candidates = top_k_per_group(
        neighbours.where(F.col(on).isNotNull()).select(
            on, F.col(neighbour_id).alias("_id"), letters.alias("_set")
        ),
        [on, "_set"],
        [F.col("_id")],
        k,
    ).drop("rank")
    key_type = persons.schema[on].dataType
    id_type = neighbours.schema[neighbour_id].dataType
    scored_type = T.StructType(
        [
            T.StructField(on, key_type),
            T.StructField("_set", T.StringType()),
            T.StructField("_id", id_type),
            T.StructField("score", T.IntegerType()),
        ]
    )
    right = _blocks(candidates, on, block_rows, ["_set", "_id"])
    right = right.withColumnsRenamed({"_size": "_size2", "_part": "_part2", "_rows": "_others"})
    seeds = _seeds(right, on, k)
    missing = F.raise_error(F.concat(F.lit(f"no neighbours for {on} "), F.col(on).cast("string")))
    open_sets = wanted.withColumn("_least", F.lit(-1))
    left = _blocks(open_sets, on, block_rows, ["_set", "_least"])
    # An exploded column, as a condition on a plain one would drop the rows before the complaint.
    seed = F.coalesce(F.col("_seed"), missing.cast("struct<_size2:int,_part2:int>"))
    first = left.join(seeds.select(on, F.struct("_size2", "_part2").alias("_seed")), on, "left")
    first = first.withColumn("_seed", F.explode(F.array(seed))).select(on, "_rows", "_seed.*")
    # Blocks of candidates grow with the data, so they are never broadcast.
    first = first.join(right.hint("merge"), [on, "_size2", "_part2"])
    first = first.select(on, "_rows", "_others").mapInPandas(_block_scorer(on, k), scored_type)
    known = top_k_per_group(first, [on, "_set"], [F.desc("score"), F.col("_id")], k)
    known = stored(known, "first-neighbours")
    lows = known.groupBy(on, "_set").agg(
        F.when(F.count("*") == k, F.min("score")).otherwise(-1).alias("_least")
    )
    left = _blocks(lows, on, block_rows, ["_set", "_least"])
    pairs = _open_pairs(left, right, seeds, on)
    pairs = pairs.join(left.drop("_low").hint("merge"), [on, "_size", "_part"]).join(
        right.hint("merge"), [on, "_size2", "_part2"]
    )
    more = pairs.select(on, "_rows", "_others").mapInPandas(_block_scorer(on, k), scored_type)
    both = known.drop("rank").unionByName(more)
    best = top_k_per_group(both, [on, "_set"], [F.desc("score"), F.col("_id")], k)
    return people.join(best, [on, "_set"]).drop("_set").withColumnRenamed("_id", neighbour_id)


def _blocks(sets: DataFrame, on: str, block_rows: int, kept: list[str]) -> DataFrame:
    """The rows of each key in lists of about ``block_rows``, of sets of one size.

    (key, _size, _part, _rows, and _low: the least score to beat, where rows have one)
    """
    sized = sets.withColumn("_size", F.length("_set"))
    counts = sized.groupBy(on, "_size").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("_count"))
    number = F.pmod(F.xxhash64("_set"), F.col("_count")).cast("int")
    numbered = sized.join(counts, [on, "_size"]).withColumn("_part", number)
    # Without this exchange the join's partitioning on the key and size would do for
    # the aggregation, and all blocks of a hot key would be built by one task.
    spread = numbered.repartition(on, "_size", "_part")
    rows = F.collect_list(F.struct(*kept)).alias("_rows")
    low = [F.min("_least").alias("_low")] if "_least" in kept else []
    return spread.groupBy(on, "_size", "_part").agg(rows, *low)


def _seeds(right: DataFrame, on: str, k: int) -> DataFrame:
    """Per key the block that is scored first: k sets or more, and of those the largest."""
    order = F.struct(F.size("_others") >= k, "_size2", -F.col("_part2"))
    chosen = F.max_by(F.struct("_size2", "_part2"), order).alias("_seed")
    return right.groupBy(on).agg(chosen).select(on, "_seed.*")


def _open_pairs(left: DataFrame, right: DataFrame, seeds: DataFrame, on: str) -> DataFrame:
    """(key, _size, _part, _size2, _part2): pairs of blocks that may still change a top list.

    A list of full length changes by a better score, or an equal one of an earlier
    neighbour, and two blocks share at most the smaller of their sizes.
    """
    met = left.select(on, "_size", "_part", "_low").join(right.select(on, "_size2", "_part2"), on)
    open_pairs = met.where(F.least("_size", "_size2") >= F.col("_low"))
    return open_pairs.join(seeds, [on, "_size2", "_part2"], "left_anti").drop("_low")


def _letter_matrix(sets: list[str], letters: dict[str, int]) -> np.ndarray:
    matrix = np.zeros((len(sets), len(letters)), dtype=np.float32)
    for row, chars in enumerate(sets):
        known = [letters[char] for char in chars if char in letters]
        matrix[row, known] = 1
    return matrix


def _block_scorer(on: str, k: int):
    def best_of(left: list[tuple[str, int]], right: list[tuple[str, object]]) -> Iterator[tuple]:
        right = sorted(right, key=lambda row: row[1])
        size = max(len(s) for s, _ in right)
        open_sets = [s for s, least in left if min(len(s), size) >= least]
        if not open_sets:
            return
        letters = {c: i for i, c in enumerate(sorted({c for s, _ in right for c in s}))}
        shared = _letter_matrix(open_sets, letters) @ _letter_matrix([s for s, _ in right], letters).T
        # One integer per pair that sorts by score, then by the earlier neighbour.
        order = shared.astype(np.int64) * len(right) - np.arange(len(right))
        count = min(k, len(right))
        picks = np.argpartition(-order, count - 1, axis=1)[:, :count]
        for row, columns in enumerate(picks):
            for column in columns:
                yield open_sets[row], right[column][1], int(shared[row, column])

    def frame_of(rows: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=[on, "_set", "_id", "score"])

    def task(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        for frame in frames:
            for key, rows, others in zip(frame[on], frame["_rows"], frame["_others"]):
                left = [(row["_set"], row["_least"]) for row in rows]
                right = [(row["_set"], row["_id"]) for row in others]
                out.extend((key, *best) for best in best_of(left, right))
                if len(out) >= OUTPUT_ROWS:
                    yield frame_of(out)
                    out = []
        yield frame_of(out)

    return task
