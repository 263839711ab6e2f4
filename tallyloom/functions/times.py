"""Timestamps as text, day truncation, epoch milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"


def to_second_text(ts: Column) -> Column:
    return F.date_format(ts, SECOND_FORMAT)


def from_second_text(text: Column) -> Column:
    return F.to_timestamp_ntz(text, F.lit(SECOND_FORMAT))


def to_day(ts: Column) -> Column:
    return F.to_date(ts)


def epoch_millis_now() -> Column:
    """Clock time in milliseconds; one value per batch or micro-batch."""
    return F.unix_millis(F.current_timestamp())
