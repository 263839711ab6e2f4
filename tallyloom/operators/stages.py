"""A Python stage: set up once per task, then any number of rows out per row in."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from itertools import batched
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

OUTPUT_ROWS = 10_000

Process = Callable[[dict[str, Any]], Iterable[tuple]]


def python_stage(rows: DataFrame, initialize: Callable[[], Process], schema: str) -> DataFrame:
    """``process(row)`` yields tuples for ``schema``; ``initialize()`` makes ``process``.

    ``initialize`` runs in each task ahead of its first row, so it may open what the
    rows need. Works on batches and streams, one task per partition.
    """
    target = T.StructType.fromDDL(schema)
    arrow = to_arrow_schema(target)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        process = initialize()
        emitted = (out for batch in batches for row in batch.to_pylist() for out in process(row))
        for chunk in batched(emitted, OUTPUT_ROWS):
            columns = [pa.array(side, type=field.type) for side, field in zip(zip(*chunk), arrow)]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return rows.mapInArrow(task, target)
