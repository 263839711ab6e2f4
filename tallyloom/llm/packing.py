"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are cut to pieces of at most the largest length. What has to be decided about
pieces depends on their lengths alone, and there are no more different lengths than the
largest permitted one: the pieces are counted by length, and best-fit decreasing packs
the counts, whole runs of equal bins at a time. So all pieces of the corpus are packed
together, not task by task. A piece then finds its bin by its rank among the pieces of
its length, which is counted in cells of bounded size.
"""

from __future__ import annotations

from collections import defaultdict
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.session import stored

CAPACITIES = (512, 1024, 2048, 4096)
# What a sequence costs beside its tokens, in tokens.
BIN_COST = 16
CELL_ROWS = 100_000
WORD = r"[^\x20\x09-\x0D]+"


@dataclass
class Plan:
    """Runs of pieces of one length: rank ``first_rank`` + k goes to bin ``first_bin`` + k."""

    runs: list[tuple[int, int, int, int, int]] = field(default_factory=list)
    # (length, first_rank, count, first_bin, offset in the bin)
    bins: list[tuple[int, int, int]] = field(default_factory=list)
    # (first_bin, count, tokens held)

    def cost(self, capacities, bin_cost: int) -> int:
        return sum(n * (_fitting(held, capacities) + bin_cost) for _, n, held in self.bins)


def _fitting(held: int, capacities) -> int:
    return min(c for c in capacities if c >= held)


def best_fit(counts: dict[int, int], capacities, opened, bin_cost: int = BIN_COST) -> Plan:
    """Best-fit decreasing over counts of lengths; new bins have a size of ``opened``.

    A piece goes to the open bin with the least room that holds it. Where none does, the
    size that is cheapest per token is opened: cost over the tokens that copies of this
    piece would fill. Bins of equal room and content are kept and moved as runs.
    """
    plan, free, next_bin = Plan(), defaultdict(list), 0
    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            room = min((r for r in free if r >= length), default=None)
            if room is None:
                size = min(
                    (c for c in opened if c >= length),
                    key=lambda c: ((c + bin_cost) / (min(c // length, left) * length), -c),
                )
                count = -(-left // (size // length))
                free[size].append((next_bin, count, 0))
                next_bin += count
                room = size
            first, count, held = free[room].pop()
            if not free[room]:
                del free[room]
            used = min(left, count)
            plan.runs.append((length, rank, used, first, held))
            free[room - length].append((first, used, held + length))
            if used < count:
                free[room].append((first + used, count - used, held))
            left, rank = left - used, rank + used
    plan.bins = sorted((first, n, held) for runs in free.values() for first, n, held in runs if held)
    return plan


def best_plan(counts: dict[int, int], capacities=CAPACITIES, bin_cost: int = BIN_COST) -> Plan:
    """The cheapest plan over all sets of sizes to open, after each bin is downsized."""
    largest = max(counts, default=0)
    plans = []
    for n in range(1, len(capacities) + 1):
        for opened in combinations(capacities, n):
            if max(opened) >= largest:
                plan = best_fit(counts, capacities, opened, bin_cost)
                plans.append((plan.cost(capacities, bin_cost), n, opened, plan))
    return min(plans, key=lambda p: p[:3])[3]


def with_lengths(documents: DataFrame) -> DataFrame:
    """(doc_id, n_tokens): words and an end mark; a null or empty text has the mark only."""
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD))
    return documents.select("doc_id", (words + 1).cast("long").alias("n_tokens"))


def pieces_of(lengths: DataFrame, largest: int) -> DataFrame:
    """(doc_id, piece, start, n_tokens): each document in pieces of at most ``largest``."""
    last = F.expr(f"CAST((n_tokens - 1) DIV {largest} AS BIGINT)")
    rows = lengths.filter("n_tokens > 0").select(
        "doc_id",
        F.col("n_tokens").alias("_all"),
        F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"),
    )
    start = F.col("piece") * largest
    return rows.select(
        "doc_id",
        "piece",
        start.alias("start"),
        F.least(F.lit(largest).cast("long"), F.col("_all") - start).alias("n_tokens"),
    )


def ranked(pieces: DataFrame, cell_rows: int = CELL_ROWS) -> DataFrame:
    """Pieces with their rank among those of equal length, from 0.

    A length may be that of very many pieces, so ranks are counted within cells and the
    cells' totals are added up. ``row`` numbers the pieces and deals them to the cells, so
    that rows without an id, or of one id, are spread like others.
    """
    cells = max(1, -(-pieces.count() // cell_rows))
    cell = F.pmod(F.xxhash64("row"), F.lit(cells))
    within = Window.partitionBy("n_tokens", "cell").orderBy("row")
    rows = stored(
        pieces.withColumn("cell", cell).withColumn("place", F.row_number().over(within) - 1),
        "packing-ranks",
    )
    sums = rows.groupBy("n_tokens", "cell").agg(F.count("*").alias("n"))
    before = Window.partitionBy("n_tokens").orderBy("cell").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = sums.select(
        "n_tokens", "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base")
    )
    return rows.join(bases, ["n_tokens", "cell"]).select(
        "doc_id", "piece", "start", "n_tokens", (F.col("base") + F.col("place")).alias("rank")
    )


PACKED = (
    "doc_id long, piece long, start long, n_tokens long, "
    "bin_id long, capacity long, bin_offset long, bin_tokens long"
)


def packed(
    lengths: DataFrame,
    capacities=CAPACITIES,
    bin_cost: int = BIN_COST,
    cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """One row per piece of (doc_id, n_tokens): where it lies and its bin's size.

    No document is dropped or shortened. Bins are numbered from 0 and have the least
    permitted size that holds their contents. Among pieces of equal length any order is
    as good; repeated rows are packed each on its own; null ids are packed, too. Documents
    longer than the largest size are cut. Rows without tokens have no piece. Extra columns
    are ignored. An empty table gives no rows.
    """
    largest = max(capacities)
    pieces = pieces_of(lengths.select("doc_id", "n_tokens"), largest)
    pieces = stored(pieces.withColumn("row", F.monotonically_increasing_id()), "pieces")
    # At most ``largest`` rows, whatever the number of pieces.
    counts = {
        row["n_tokens"]: row["n"]
        for row in pieces.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()
    }
    plan = best_plan(counts, capacities, bin_cost)
    spark = lengths.sparkSession
    shared = spark.sparkContext.broadcast((_by_length(plan), _contents(plan), tuple(capacities)))
    return ranked(pieces, cell_rows).mapInPandas(_placed(shared), PACKED)


def _by_length(plan: Plan) -> dict[int, np.ndarray]:
    found = defaultdict(list)
    for length, *run in plan.runs:
        found[length].append(run)
    return {length: np.array(sorted(runs), np.int64) for length, runs in found.items()}


def _contents(plan: Plan) -> np.ndarray:
    return np.array(plan.bins, np.int64).reshape(-1, 3)


def _placed(shared):
    def run(batches):
        runs, bins, capacities = shared.value
        sizes = np.array(sorted(capacities))
        for batch in batches:
            parts = []
            for length, rows in batch.groupby("n_tokens", sort=False):
                own = runs[length]
                rank = rows["rank"].to_numpy()
                at = np.searchsorted(own[:, 0], rank, side="right") - 1
                bin_id = own[at, 2] + rank - own[at, 0]
                held = bins[np.searchsorted(bins[:, 0], bin_id, side="right") - 1, 2]
                parts.append(
                    rows.drop(columns="rank").assign(
                        bin_id=bin_id,
                        capacity=sizes[np.searchsorted(sizes, held)],
                        bin_offset=own[at, 3],
                        bin_tokens=held,
                    )
                )
            if parts:
                out = pd.concat(parts)
                yield out.assign(doc_id=out["doc_id"].astype("Int64"))

    return run
