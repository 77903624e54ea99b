"""Keyed event-time replay: the stateful processor behind the stream operators."""

from __future__ import annotations

import json
from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType, TimestampType

from tidemark.streaming.waiting import Waiting, plain

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

MEMORY = "memory string"
VALUES = ["_a", "_b", "_n"]
COLUMNS = ["_ts", *VALUES, "_kind", "_left", "_right"]


def output(body: StructType) -> list[StructField]:
    """The columns of a machine's output; whole rows are typed as they are waiting."""
    return [
        StructField("_ts", TimestampType()),
        *[StructField(name, LongType()) for name in VALUES],
        StructField("_kind", StringType()),
        StructField("_left", body),
        StructField("_right", body),
    ]


class OrderedReplay(StatefulProcessor):
    """Feeds the rows of a key to a machine in ``(time, seq)`` order.

    Rows wait in time buckets until the watermark has reached them, so rows that arrive out
    of order are put right and a row later than the watermark, which Spark drops, could
    not have changed anything.  One event-time timer per key wakes it up for the next
    waiting row or the next deadline.  What a machine remembers is text, but for a whole row
    (``body``), which is kept as it is.
    """

    def __init__(self, machine, keys: list[str], row: StructType):
        self.machine = machine
        self.keys = keys
        self.row = row

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Waiting(handle, self.row)
        self.memory = handle.getValueState("memory", MEMORY)
        self.held = handle.getValueState("held", StructType([self.row["body"]]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._wake(self.waiting.add((r["_us"], r["_seq"], r["_tag"], r["_body"]) for r in rows))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        stored = self.memory.get()
        memory = json.loads(stored[0]) if stored else {}
        if memory.pop("holds", False):
            memory["body"] = plain(self.held.get()[0])

        out = []
        for ready in self.waiting.due(now):
            for us, _, tag, body in sorted(ready, key=self._order):
                out.extend(self.machine.advance(memory, us))
                out.extend(self.machine.step(memory, us, tag, body))
        out.extend(self.machine.advance(memory, now))

        wake = [us for us in (self.waiting.first(), self.machine.due(memory)) if us is not None]
        if "body" in memory:
            self.held.update((memory.pop("body"),))
            memory["holds"] = True
        elif self.held.exists():
            self.held.clear()
        if memory:
            self.memory.update((json.dumps(memory),))
        elif stored:
            self.memory.clear()
        if wake:
            self._wake(min(wake))
        for values in out:
            yield self._row(key, values, now)

    def _order(self, row):
        us, seq, tag, _ = row
        return (us, tag, seq) if getattr(self.machine, "tag_first", False) else (us, seq)

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def _row(self, key, values, now):
        """The key, the time of the emitted row (of the decision if it has none) and its values."""
        us = values.get("_a")
        ts = EPOCH + timedelta(microseconds=now if us is None else us)
        return Row(*self.keys, *COLUMNS)(*key, ts, *[values.get(c) for c in COLUMNS[1:]])

    def close(self) -> None:
        pass


def replay(
    rows: DataFrame,
    keys: list[str],
    machine,
    ts: str,
    seq: str,
    tag: Column,
    body: Column | None = None,
    event_time: str = "",
) -> DataFrame:
    """The machine's output for every key of a watermarked stream, with ``COLUMNS``.

    ``body`` is a struct that comes back in ``_left`` or ``_right``.
    """
    # Positions in files are text; everything else orders as a number.
    seq_type = StringType() if rows.schema[seq].dataType == StringType() else LongType()
    fed = rows.select(
        *keys,
        F.col(ts),
        F.unix_micros(F.col(ts).cast("timestamp")).alias("_us"),
        F.col(seq).cast(seq_type).alias("_seq"),
        tag.cast("int").alias("_tag"),
        (F.lit(None).cast("struct<none: int>") if body is None else body).alias("_body"),
    )
    body_type = fed.schema["_body"].dataType
    waiting = StructType(
        [
            StructField("us", LongType()),
            StructField("seq", seq_type),
            StructField("tag", IntegerType()),
            StructField("body", body_type),
        ]
    )
    schema = StructType([rows.schema[k] for k in keys] + output(body_type))
    return fed.groupBy(*keys).transformWithState(
        OrderedReplay(machine, keys, waiting), schema, "append", "EventTime", eventTimeColumnName=event_time
    )
