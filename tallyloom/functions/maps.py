"""Maps and pairs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def merge_maps(first: Column, second: Column) -> Column:
    """All entries of two maps; the second one wins on a key that both have."""
    rest = F.map_filter(first, lambda key, _value: ~F.map_contains_key(second, key))
    return F.map_concat(rest, second)


def swap(pair: Column) -> Column:
    """A struct of two fields the other way round, named ``first`` and ``second``."""
    return F.struct(pair["second"].alias("first"), pair["first"].alias("second"))
