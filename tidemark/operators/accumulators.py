"""Aggregates that a user writes: create, add, merge, result."""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# Keys that a task holds before it hands on what it has.
MOST_KEYS = 100_000


class Accumulator(Protocol):
    """``fields`` and ``result_fields`` say, as in a schema, what the tuples hold that stand for
    what has been added so far and for the result.

    Adding rows in any order, to any number of accumulators that are then merged, must give
    the same result.
    """

    fields: str
    result_fields: str

    def create(self) -> tuple: ...

    def add(self, held: tuple, *values) -> tuple: ...

    def merge(self, held: tuple, other: tuple) -> tuple: ...

    def result(self, held: tuple) -> tuple: ...


def aggregate(df: DataFrame, keys: list[str], accumulator: Accumulator, values: list[str]) -> DataFrame:
    """``keys`` and the results of the accumulator over ``values``, one row per key (batch only).

    Every task adds its rows to accumulators of its own, so a key is shuffled as one row per
    task (or per ``MOST_KEYS`` keys), however many rows it has; what is shuffled is merged in
    the order of the keys with one accumulator in memory.  NULL keys are a key.
    """
    if df.isStreaming:
        raise ValueError("an accumulator needs a batch")
    key_fields = [df.schema[k] for k in keys]
    held = StructType(key_fields + StructType.fromDDL(accumulator.fields).fields)
    result = StructType(key_fields + StructType.fromDDL(accumulator.result_fields).fields)
    partial = df.select(*keys, *values).mapInArrow(_adder(len(keys), accumulator, to_arrow_schema(held)), held)
    merged = partial.repartition(*keys) if keys else partial.coalesce(1)
    ordered = merged.sortWithinPartitions(*keys) if keys else merged
    return ordered.mapInArrow(_merger(len(keys), accumulator, to_arrow_schema(result)), result)


def _rows(batch: pa.RecordBatch) -> Iterator[tuple]:
    return zip(*(column.to_pylist() for column in batch.columns), strict=True)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(schema)
    arrays = [pa.array(c, field.type) for c, field in zip(columns, schema, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def _adder(n: int, accumulator: Accumulator, schema: pa.Schema):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple] = {}
        for batch in batches:
            for row in _rows(batch):
                key = row[:n]
                held[key] = accumulator.add(held[key] if key in held else accumulator.create(), *row[n:])
            if len(held) > MOST_KEYS:
                yield _batch([k + tuple(v) for k, v in held.items()], schema)
                held = {}
        yield _batch([k + tuple(v) for k, v in held.items()], schema)

    return add


def _merger(n: int, accumulator: Accumulator, schema: pa.Schema):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, None
        for batch in batches:
            done = []
            for row in _rows(batch):
                if held is not None and row[:n] == key:
                    held = accumulator.merge(held, row[n:])
                    continue
                if held is not None:
                    done.append(key + tuple(accumulator.result(held)))
                key, held = row[:n], row[n:]
            yield _batch(done, schema)
        if held is not None:
            yield _batch([key + tuple(accumulator.result(held))], schema)

    return merge


class Moments:
    """Number, mean and population variance of a column; NULLs do not count."""

    fields = "n long, mean double, squares double"
    result_fields = "n long, mean double, variance double"

    def create(self) -> tuple:
        return 0, 0.0, 0.0

    def add(self, held: tuple, value) -> tuple:
        return held if value is None else self.merge(held, (1, float(value), 0.0))

    def merge(self, held: tuple, other: tuple) -> tuple:
        n = held[0] + other[0]
        if not held[0] or not other[0]:
            return held if other[0] == 0 else other
        gap = other[1] - held[1]
        return n, held[1] + gap * other[0] / n, held[2] + other[2] + gap * gap * held[0] * other[0] / n

    def result(self, held: tuple) -> tuple:
        n, mean, squares = held
        return (n, mean, squares / n) if n else (0, None, None)
