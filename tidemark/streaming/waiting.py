"""Rows of a key that wait for the watermark, in time buckets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

from pyspark.sql.streaming import StatefulProcessorHandle
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

# Width of a bucket, in microseconds.
BUCKET = 1_000_000


def plain(value):
    """Rows as tuples, also within: state takes no rows inside of rows."""
    if isinstance(value, tuple):
        return tuple(map(plain, value))
    return list(map(plain, value)) if isinstance(value, list) else value


class Waiting:
    """Typed rows, the first field their time in microseconds, kept by ``BUCKET``.

    What arrives in a micro-batch is added as a part of its buckets, nothing is rewritten,
    and taking the rows that are due reads their buckets only: a key with many waiting rows
    costs a timer no more than what it gives out and the list of the buckets.
    """

    def __init__(self, handle: StatefulProcessorHandle, row: StructType):
        bucket = StructType([StructField("bucket", LongType())])
        part = StructType([StructField("bucket", LongType()), StructField("part", LongType())])
        parts = StructType([StructField("parts", LongType()), StructField("first", LongType())])
        rows = StructType([StructField("rows", ArrayType(row))])
        self.buckets = handle.getMapState("waiting_buckets", bucket, parts)
        self.rows = handle.getMapState("waiting_rows", part, rows)

    def add(self, rows: Iterable[tuple]) -> int:
        """Keep the rows; gives the earliest time among them."""
        arrived: dict[int, list[tuple]] = {}
        for row in rows:
            arrived.setdefault(row[0] // BUCKET, []).append(plain(row))
        for bucket, part in arrived.items():
            self._append(bucket, part)
        return min(row[0] for part in arrived.values() for row in part)

    def _append(self, bucket: int, part: list[tuple]) -> None:
        known = self.buckets.getValue((bucket,)) if self.buckets.containsKey((bucket,)) else (0, None)
        first = min(row[0] for row in part)
        self.rows.updateValue((bucket, known[0]), (part,))
        self.buckets.updateValue((bucket,), (known[0] + 1, first if known[1] is None else min(first, known[1])))

    def due(self, now: int) -> Iterator[list[tuple]]:
        """The rows up to ``now``, removed, bucket by bucket in the order of time; unsorted within."""
        known = sorted((bucket, parts) for (bucket,), (parts, first) in self.buckets.iterator() if first <= now)
        for bucket, parts in known:
            held = []
            for part in range(parts):
                held.extend(plain(row) for row in self.rows.getValue((bucket, part))[0])
                self.rows.removeKey((bucket, part))
            self.buckets.removeKey((bucket,))
            late = [row for row in held if row[0] > now]
            if late:
                self._append(bucket, late)
            yield [row for row in held if row[0] <= now]

    def first(self) -> int | None:
        """The time of the earliest waiting row."""
        return min((first for _, (_, first) in self.buckets.iterator()), default=None)
