"""Sliding totals by arrival time, kept as pane totals in keyed state."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STATE = "total bigint, panes array<bigint>, sums array<bigint>, ended bigint"
# Windows of a key that one state ends, at least.
STRETCH = 8192


def sliding_totals(
    rows: DataFrame,
    arrived: str,
    keys: Sequence[str],
    window_seconds: int = 60,
    slide_seconds: int = 20,
    weight: Column | None = None,
    clock: DataFrame | None = None,
) -> DataFrame:
    """Totals ``(win_start, *keys, n)`` of a stream for every window that has ended.

    A row counts when it arrives: ``arrived`` is the TIMESTAMP that it was stamped with
    (see ``stamped_now``), so windows need no allowance for late rows. The state of a key
    is its current total and one sum per slide-wide pane of the window. A window's total
    is the one before plus the pane that enters minus the pane that leaves, whatever the
    window's length, and a key without panes has no state.

    A state ends the windows of one stretch of time, so that a backlog of one key, of any
    length, is many states of bounded size that many tasks share. Panes whose windows
    start in two stretches go to both.

    A window is appended once, when a row has arrived after its end; keys that get no rows
    any more are woken by timers. ``clock``, a stream with a TIMESTAMP ``at`` such as
    ``ticks`` gives, moves the time on where no rows come at all.

    Each Arrow batch is summed by key and pane before the shuffle. Null keys are a group,
    null weights count zero, and rows without a stamp have no window. A stamp that lies
    one pane or more before the latest of an earlier micro-batch, which a clock does not
    give, comes too late for its window and is left out.
    """
    overlap, rest = divmod(window_seconds, slide_seconds)
    if rest or overlap < 1:
        raise ValueError("the window has to be a multiple of the slide")
    slide_ms = slide_seconds * 1000
    amount = F.lit(1) if weight is None else F.coalesce(weight, F.lit(0))
    key_types = [T.StructField(f"_key{i}", rows.schema[key].dataType) for i, key in enumerate(keys)]
    names = [field.name for field in key_types]
    pane = F.floor(F.unix_millis(arrived) / slide_ms).alias("_pane")
    slim = rows.where(F.col(arrived).isNotNull()).select(
        *[F.col(key).alias(name) for key, name in zip(keys, names)],
        F.lit(False).alias("_clock"),
        pane,
        amount.cast("bigint").alias("_sum"),
    )
    if clock is not None:
        slim = slim.unionByName(
            clock.where(F.col("at").isNotNull()).select(
                *[F.lit(None).cast(field.dataType).alias(field.name) for field in key_types],
                F.lit(True).alias("_clock"),
                F.floor(F.unix_millis("at") / slide_ms).alias("_pane"),
                F.lit(0).cast("bigint").alias("_sum"),
            )
        )
    summed = slim.mapInArrow(_pane_sums([*names, "_clock", "_pane"]), slim.schema)
    stretch = max(STRETCH, 4 * overlap)
    starts = [F.floor((F.col("_pane") - back) / stretch) for back in (overlap - 1, 0)]
    summed = summed.withColumn("_stretch", F.explode(F.array_distinct(F.array(*starts))))
    # The watermark is the start of the latest pane: all windows up to there have ended.
    timed = summed.withColumn("_until", F.timestamp_millis((F.col("_pane") + 1) * slide_ms)).withWatermark(
        "_until", f"{slide_seconds} seconds"
    )
    ended = T.StructType([*key_types, T.StructField("_start", T.LongType()), T.StructField("n", T.LongType())])
    totals = timed.groupBy(*names, "_clock", "_stretch").applyInPandasWithState(
        _advance(names, overlap, slide_ms, stretch), ended, STATE, "append", GroupStateTimeout.EventTimeTimeout
    )
    return totals.select(
        F.timestamp_millis(F.col("_start") * slide_ms).alias("win_start"),
        *[F.col(name).alias(key) for key, name in zip(keys, names)],
        "n",
    )


def _pane_sums(names: list[str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                held = pa.Table.from_batches([batch]).group_by(names).aggregate([("_sum", "sum")])
                yield from held.select([*names, "_sum_sum"]).rename_columns([*names, "_sum"]).to_batches()

    return sums


def _advance(names: list[str], overlap: int, slide_ms: int, stretch: int):
    """State function of a key's stretch: add the new panes, end the windows that are over."""

    def advance(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        *values, is_clock, number = key
        if is_clock:
            return
        # The window before the stretch's first; it holds panes of the first too.
        total, held, end = 0, {}, int(number) * stretch + overlap - 1
        last = end + stretch
        if state.exists:
            total, panes, sums, end = state.get
            held = dict(zip(panes, sums))
        for rows in frames:
            for pane, n in zip(rows["_pane"].tolist(), rows["_sum"].tolist()):
                held[pane] = held.get(pane, 0) + n
                if pane < end:
                    total += n
        now = state.getCurrentWatermarkMs() // slide_ms
        panes = sorted(held)
        left, entered, following = 0, bisect_left(panes, end), end + 1
        over = []
        while left < len(panes):
            # Where the window is empty, go on to the first pane to come.
            following = end + 1 if panes[left] < end else panes[left] + 1
            if following > min(now, last):
                break
            end = following
            while entered < len(panes) and panes[entered] < end:
                total += held[panes[entered]]
                entered += 1
            while left < entered and panes[left] < end - overlap:
                total -= held[panes[left]]
                left += 1
            if left < entered:
                over.append((end - overlap, total))
        if left < len(panes) and following <= last:
            kept = panes[left:]
            state.update((total, kept, [held[pane] for pane in kept], end))
            state.setTimeoutTimestamp(following * slide_ms - 1)
        elif state.exists:
            state.remove()
        if over:
            yield pd.DataFrame(
                {
                    **{name: [value] * len(over) for name, value in zip(names, values)},
                    "_start": [start for start, _ in over],
                    "n": [n for _, n in over],
                }
            )

    return advance
