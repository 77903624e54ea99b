"""Runs an operator over a directory of files as a stream and collects what it appends."""

from __future__ import annotations

import tempfile
from datetime import timedelta

from helpers import frame, rows_of

from tidemark.operators import with_event_time

FAR = 10_000_000  # seconds after the base: a sentinel row that closes everything before it


def as_stream(spark, rows, schema, sentinel, delay=timedelta(0), parts=3, ts="ts", order=None):
    """``rows`` in ``parts`` files, one per micro-batch, then the sentinel in two more.

    No ``delay`` leaves the watermark to the caller.
    """
    path = tempfile.mkdtemp(prefix="stream-")
    rows = sorted(rows, key=order) if order else rows
    size = -(-len(rows) // parts) or 1
    chunks = [rows[i : i + size] for i in range(0, len(rows), size)]
    for number, chunk in enumerate([*chunks, [sentinel(FAR)], [sentinel(FAR + 1)]]):
        frame(spark, chunk, schema).coalesce(1).write.mode("append").parquet(f"{path}/{number:03d}")
    stream = (
        spark.readStream.schema(frame(spark, [], schema).schema)
        .option("maxFilesPerTrigger", 1)
        .option("latestFirst", "false")
        .parquet(f"{path}/*")
    )
    return stream if delay is None else with_event_time(stream, ts, delay)


def drain(spark, df, mode="append"):
    """All rows the stream gives until its files are used up."""
    name = f"out_{next(_numbers)}"
    query = (
        df.writeStream.format("memory")
        .queryName(name)
        .outputMode(mode)
        .option("checkpointLocation", tempfile.mkdtemp(prefix="checkpoint-"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination(300)
    if query.exception():
        raise query.exception()
    return spark.table(name)


def drained(spark, df, *columns):
    return rows_of(drain(spark, df), *columns)


def _count():
    n = 0
    while True:
        yield n
        n += 1


_numbers = _count()
