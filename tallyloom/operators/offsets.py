"""Log records with the offset range they were read in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ENVELOPE = ["key", "value", "topic", "partition", "offset"]


def envelope(records: DataFrame) -> DataFrame:
    """Key, value and position of each record, without the rest of the source's columns."""
    return records.select(*ENVELOPE)


def handle_messages(records: DataFrame, handler: Sequence[Column]) -> DataFrame:
    """A message handler: any expressions over the envelope."""
    return records.select(*handler)


def batch_ranges(records: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """``[from_offset, until_offset)`` read per topic partition (and batch)."""
    return records.groupBy(*batch, "topic", "partition").agg(
        F.min("offset").alias("from_offset"), (F.max("offset") + 1).alias("until_offset")
    )


def with_batch_offsets(records: DataFrame, batch: Sequence[str] = ()) -> DataFrame:
    """Each record with the offset range of its batch and topic partition."""
    return records.join(batch_ranges(records, batch), [*batch, "topic", "partition"])


def with_record_offsets(records: DataFrame) -> DataFrame:
    """Each record with its own range ``[offset, offset + 1)``."""
    return records.withColumns(
        {"from_offset": F.col("offset"), "until_offset": F.col("offset") + 1}
    )
