"""Map / combine / reduce over ``(key, value)`` rows, on Spark partitions and shuffles.

Python functions run inside ``mapInArrow`` tasks. The map and combine steps run
in the task that reads the rows, the exchange is a hash shuffle on the key, and
the reduce step reads each key's values as a stream from the sorted partition.
No list of all values of a key is ever built, so a hot key costs time but not
memory; give a combiner and it costs little time either.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tallyloom.session import stored

Pairs = Iterable[tuple[Any, Any]]
MapFunction = Callable[[Any, Any], Pairs]
GroupFunction = Callable[[Any, Iterable[Any]], Pairs]

OUTPUT_ROWS = 10_000
BUFFERED_VALUES = 100_000


def identity_map(key: Any, value: Any) -> Pairs:
    yield key, value


def identity_reduce(key: Any, values: Iterable[Any]) -> Pairs:
    return ((key, value) for value in values)


def map_reduce(
    pairs: DataFrame,
    map_f: MapFunction | None = None,
    reduce_f: GroupFunction | None = None,
    combine_f: GroupFunction | None = None,
    *,
    mapped_schema: str | T.StructType | None = None,
    result_schema: str | T.StructType | None = None,
    num_mappers: int | None = None,
) -> DataFrame:
    """``map_f(k, v)``, then ``combine_f(k, values)`` per part, then ``reduce_f(k, values)``.

    ``pairs`` has two columns, key first. Each function yields pairs; a function
    left out is the identity. ``mapped_schema`` describes the pairs after map and
    combine, ``result_schema`` those after reduce; both default to the schema of
    the step before. ``combine_f`` may run zero, one or many times on a key, also
    on its own output, so it has to be associative. ``values`` is an iterator
    that can be read once.

    ``num_mappers`` spreads the input at random over that many parts first; the
    result does not depend on it. By default the parts are the scan's own
    partitions, which costs no extra shuffle.
    """
    if len(pairs.columns) != 2:
        raise ValueError(f"map_reduce needs a key and a value column, not {pairs.columns}")
    source = pairs if num_mappers is None else random_parts(pairs, num_mappers)
    mapped = _map_side(source, map_f, combine_f, mapped_schema)
    if reduce_f is None:
        return mapped if result_schema is None else mapped.to(_schema(result_schema))
    key = mapped.columns[0]
    shuffled = mapped.repartition(F.col(f"`{key}`")).sortWithinPartitions(F.col(f"`{key}`"))
    target = _schema(result_schema) if result_schema is not None else mapped.schema
    return shuffled.mapInArrow(_reducer(reduce_f, to_arrow_schema(target)), target)


def _map_side(
    source: DataFrame,
    map_f: MapFunction | None,
    combine_f: GroupFunction | None,
    mapped_schema: str | T.StructType | None,
) -> DataFrame:
    if map_f is None and combine_f is None:
        return source if mapped_schema is None else source.to(_schema(mapped_schema))
    target = _schema(mapped_schema) if mapped_schema is not None else source.schema
    task = _mapper(map_f or identity_map, combine_f, to_arrow_schema(target))
    return source.mapInArrow(task, target)


def _schema(schema: str | T.StructType) -> T.StructType:
    parsed = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if len(parsed.fields) != 2:
        raise ValueError("a pair schema has exactly two fields")
    return parsed


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, Any]]:
    for batch in batches:
        yield from zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())


def _batches(pairs: Pairs, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    for chunk in itertools.batched(pairs, OUTPUT_ROWS):
        keys, values = zip(*chunk)
        arrays = [pa.array(side, type=field.type) for side, field in zip((keys, values), schema)]
        yield pa.RecordBatch.from_arrays(arrays, schema=schema)


def _group_key(key: Any) -> Any:
    """Hashable stand-in for a key; NaN equals NaN and -0.0 equals 0.0, also inside."""
    if isinstance(key, float):
        return "NaN" if key != key else key + 0.0
    if isinstance(key, list):
        return tuple(_group_key(item) for item in key)
    if isinstance(key, dict):
        return tuple((name, _group_key(item)) for name, item in key.items())
    return key


def _combined(pairs: Pairs, combine_f: GroupFunction) -> Iterator[tuple[Any, Any]]:
    """Combine in a bounded buffer; output that cannot shrink further is sent on."""
    buffer: dict[Any, tuple[Any, list[Any]]] = {}
    buffered = 0

    def add(key: Any, value: Any) -> None:
        buffer.setdefault(_group_key(key), (key, []))[1].append(value)

    def drain() -> list[tuple[Any, Any]]:
        out = [pair for key, values in buffer.values() for pair in combine_f(key, iter(values))]
        buffer.clear()
        return out

    for key, value in pairs:
        add(key, value)
        buffered += 1
        if buffered >= BUFFERED_VALUES:
            combined = drain()
            buffered = 0
            if len(combined) > BUFFERED_VALUES // 2:
                yield from combined
            else:
                for pair in combined:
                    add(*pair)
                buffered = len(combined)
    yield from drain()


def _mapper(map_f: MapFunction, combine_f: GroupFunction | None, schema: pa.Schema):
    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = (pair for key, value in _rows(batches) for pair in map_f(key, value))
        yield from _batches(mapped if combine_f is None else _combined(mapped, combine_f), schema)

    return task


def _reducer(reduce_f: GroupFunction, schema: pa.Schema):
    def reduced(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[Any, Any]]:
        for _, rows in itertools.groupby(_rows(batches), key=lambda row: _group_key(row[0])):
            key, value = next(rows)
            yield from reduce_f(key, itertools.chain([value], (other for _, other in rows)))

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches(reduced(batches), schema)

    return task


def map_reduce_columns(
    rows: DataFrame, emitted: Column, **aggregates: Column
) -> DataFrame:
    """The JVM-side form: ``emitted`` is an array of ``(key, value)`` structs per row.

    Each keyword names an aggregate over ``value``; Catalyst does the partial
    aggregation before the shuffle.
    """
    pairs = rows.select(F.inline(emitted).alias("key", "value"))
    return pairs.groupBy("key").agg(*[agg.alias(name) for name, agg in aggregates.items()])


def regrouped(pairs: DataFrame, per_part: int = 100_000) -> DataFrame:
    """Pairs shuffled by key: what identity map and reduce leave, row by row.

    Such a reducer looks at one value at a time, so a key of many values is dealt to as
    many parts as it has ``per_part`` values.
    """
    key, value = pairs.columns
    share = F.pmod(F.xxhash64(F.col(f"`{value}`")), F.col("_parts"))
    sizes = pairs.groupBy(F.col(f"`{key}`").alias("_key")).agg(
        F.ceil(F.count(F.lit(1)) / per_part).alias("_parts")
    )
    spread = pairs.join(sizes, F.col(f"`{key}`").eqNullSafe(F.col("_key"))).withColumn("_share", share)
    return spread.repartition(F.col(f"`{key}`"), F.col("_share")).select(*pairs.columns)


def random_parts(rows: DataFrame, num_parts: int) -> DataFrame:
    """Spread rows evenly over ``num_parts`` partitions, whatever they hold.

    Spark deals the rows out after a local sort, so a retried task deals them
    the same way again.
    """
    if num_parts < 1:
        raise ValueError("num_parts must be at least 1")
    return rows.repartition(num_parts)


def grouped_lists(pairs: DataFrame, max_values: int = 100_000) -> DataFrame:
    """Shuffle result ``key -> [values]`` as rows ``(key, chunk, values)``.

    Values are in ascending order, nulls first. A row holds ``max_values`` of them, the
    last row of a key the rest, and ``chunk`` numbers the rows of a key in that order: the
    lists of a key one after the other are its whole sorted list, whatever the bound.

    Equal pairs are counted first. The counts are dealt out by ranges of key and value,
    so that a key with very many values lies in many tasks; a pair's place follows from
    the totals of its key in the ranges before and the running total in its own.
    """
    key, value = pairs.columns
    named = pairs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{value}`").alias("value"))
    counted = named.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n"))
    ranged = stored(
        counted.repartitionByRange("key", "value").withColumn("part", F.spark_partition_id()),
        "grouped-lists",
    )
    before = Window.partitionBy("key").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        ranged.groupBy("key", "part")
        .agg(F.sum("n").alias("total"))
        .select("key", "part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
        .select(F.col("key").alias("_key"), F.col("part").alias("_part"), "base")
    )
    inside = (
        Window.partitionBy("part", "key").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    )
    placed = ranged.withColumn("_end", F.sum("n").over(inside)).join(
        bases, (F.col("part") == F.col("_part")) & F.col("key").eqNullSafe(F.col("_key"))
    )
    end = F.col("base") + F.col("_end")
    first = end - F.col("n")
    runs = placed.select(
        "key", "value", first.alias("first"), end.alias("end"),
        F.explode(
            F.sequence(F.expr(f"(base + _end - n) DIV {max_values}"), F.expr(f"(base + _end - 1) DIV {max_values}"))
        ).alias("chunk"),
    )
    low = F.greatest("first", F.col("chunk") * max_values)
    high = F.least("end", (F.col("chunk") + 1) * max_values)
    parts = runs.select(
        "key", F.col("chunk").cast("int").alias("chunk"),
        F.struct(F.col("first"), F.array_repeat("value", (high - low).cast("int")).alias("run")).alias("part"),
    )
    return (
        # Not left to the join's partitioning, which would put a hot key in one task.
        parts.repartition("key", "chunk")
        .groupBy("key", "chunk")
        .agg(F.flatten(F.sort_array(F.collect_list("part"))["run"]).alias("values"))
    )


def key_sorted_lists(pairs: DataFrame, max_values: int = 100_000) -> DataFrame:
    """``grouped_lists`` in key order: the result shape ``[(key, [values])]``."""
    return grouped_lists(pairs, max_values).orderBy("key", "chunk")


def pair_stats(pairs: DataFrame, stage: str) -> DataFrame:
    """Rows ``(stage, part, n_keys, n_values)``: sizes of each partition of a stage."""
    key = pairs.columns[0]
    return (
        pairs.groupBy(F.spark_partition_id().alias("part"), F.col(f"`{key}`").alias("_key"))
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy("part")
        .agg(F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_values"))
        .select(F.lit(stage).alias("stage"), "part", "n_keys", "n_values")
    )


def token_counts(docs: DataFrame, tokens: Column, word: str = "word", n: str = "n") -> DataFrame:
    """Word count: tokens exploded and counted, partial counts before the shuffle."""
    return (
        docs.select(F.explode(tokens).alias(word))
        .groupBy(word)
        .agg(F.count(F.lit(1)).alias(n))
    )
