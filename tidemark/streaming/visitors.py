"""Running distinct counts on a stream: a row per event."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType, TimestampType

from tidemark.functions import from_epoch_us
from tidemark.streaming.patterns import packed, unpacked
from tidemark.streaming.waiting import Waiting, plain

EPOCH = datetime(1970, 1, 1, tzinfo=timezone.utc)

# A window's values are dealt over so many groups, and its time is cut into so many slots.
GROUPS, SLOTS = 64, 60


def instant(us: int) -> datetime:
    return EPOCH + timedelta(microseconds=us)


class FirstSeen(StatefulProcessor):
    """Tells which rows of some values of a window are the first of their value, in
    ``(time, seq)`` order, and how many such rows each slot has."""

    def __init__(self, fields: list[str], waiting: StructType, size: int, slot: int):
        self.fields, self.row, self.size, self.slot = fields, waiting, size, slot

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = Waiting(handle, self.row)
        self.seen = handle.getMapState("seen", StructType([self.row["value"]]), "n int")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        self._wake(self.waiting.add((r["_us"], r["_seq"], r["_value"], r["_row"]) for r in rows))
        self._wake(key[0] + self.size)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, start = timerValues.getCurrentWatermarkInMs() * 1000, key[0]
        new_in: dict[int, int] = {}
        for ready in self.waiting.due(now):
            for us, seq, value, row in sorted(ready, key=lambda r: r[:2]):
                new = value is not None and not self.seen.containsKey((value,))
                at = start + (us - start) // self.slot * self.slot
                if new:
                    self.seen.updateValue((value,), (1,))
                    new_in[at] = new_in.get(at, 0) + 1
                yield self._out(*key, instant(us), at, us, seq, new, None, row)
        # What a slot has in first rows counts in all later slots of its window; such a number
        # is in time as long as that slot is.
        for at, count in new_in.items():
            for later in range(at + self.slot, start + self.size, self.slot):
                yield self._out(*key, instant(later + self.slot - 1), later, None, None, None, count, None)
        first = self.waiting.first()
        if first is not None:
            self._wake(first)
        elif now >= start + self.size:
            self.seen.clear()

    def _out(self, *values) -> Row:
        return Row(*self.fields)(*values)

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def close(self) -> None:
        pass


class SlotCount(StatefulProcessor):
    """Numbers the rows of a slot, from what the slots before it have.

    All rows up to the watermark, and the numbers of the slots before, are there in the same
    micro-batch, so only the count so far is kept.
    """

    def __init__(self, fields: list[str], size: int):
        self.fields, self.size = fields, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.count = handle.getValueState("count", "n bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        known = self.count.get()
        count, events = (known[0] if known else 0), []
        for row in rows:
            if row["_count"] is None:
                events.append((row["_us"], row["_seq"], row["_new"], row["_row"]))
            else:
                count += row["_count"]
        for us, _, new, row in sorted(events, key=lambda r: r[:2]):
            count += new
            yield Row(*self.fields)(*key, instant(us), count, new, plain(row))
        self.count.update((count,))
        self.handle.registerTimer(-(-(key[0] + self.size) // 1000))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.count.clear()
        return iter(())

    def close(self) -> None:
        pass


def running_distinct(df: DataFrame, col: str, size: int, ts: str, seq: str, groups: int = GROUPS, slots: int = SLOTS) -> DataFrame:
    """The columns of ``df`` with ``window_end``, ``uv`` and ``is_new``, once the watermark has
    passed a row; ``size`` in microseconds.

    First the values of a window are dealt over ``groups``, which find out the first row of
    each.  Then the rows meet by time slot, with the numbers of first rows in earlier slots, so
    a window is never in one task.
    """
    slot = max(1, -(-size // slots))
    us = F.unix_micros(F.col(ts).cast("timestamp"))
    seq_type = StringType() if df.schema[seq].dataType == StringType() else LongType()
    fed = df.select(
        (us - F.pmod(us, F.lit(size))).alias("_start"),
        F.pmod(F.xxhash64(col), F.lit(groups)).cast("int").alias("_group"),
        F.col(ts),
        us.alias("_us"),
        F.col(seq).cast(seq_type).alias("_seq"),
        F.col(col).alias("_value"),
        packed(df, df.columns).alias("_row"),
    )
    row, value = fed.schema["_row"].dataType, fed.schema["_value"].dataType
    waiting = StructType(
        [StructField("us", LongType()), StructField("seq", seq_type), StructField("value", value), StructField("row", row)]
    )
    marked_fields = [
        fed.schema["_start"], fed.schema["_group"], StructField("_ts", TimestampType()), StructField("_slot", LongType()),
        StructField("_us", LongType()), StructField("_seq", seq_type), StructField("_new", BooleanType()),
        StructField("_count", LongType()), StructField("_row", row),
    ]
    names = [f.name for f in marked_fields]
    marked = fed.groupBy("_start", "_group").transformWithState(
        FirstSeen(names, waiting, size, slot), StructType(marked_fields), "append", "EventTime", eventTimeColumnName="_ts"
    )
    counted_fields = [
        fed.schema["_start"], StructField("_slot", LongType()), StructField("_ts", TimestampType()),
        StructField("uv", LongType()), StructField("is_new", BooleanType()), StructField("_row", row),
    ]
    counted = marked.groupBy("_start", "_slot").transformWithState(
        SlotCount([f.name for f in counted_fields], size), StructType(counted_fields), "append", "EventTime", eventTimeColumnName="_ts"
    )
    rows = dict(zip(df.columns, unpacked(df, df.columns, "_row"), strict=True))
    rows[ts] = F.col("_ts").cast(df.schema[ts].dataType).alias(ts)
    window_end = from_epoch_us(F.col("_start") + F.lit(size), df.schema[ts].dataType).alias("window_end")
    return counted.select(*[rows[c] for c in df.columns], window_end, "uv", "is_new")
