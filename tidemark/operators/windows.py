"""Counts over tumbling and sliding event-time windows.

Windows are ``[start, end)``, aligned to the epoch and labelled by ``window_end``.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import as_duration, epoch_us, floor_us, from_epoch_us, to_us
from tidemark.streaming import panes as stream_panes

# Window ends per task group when the running count of a sliding window is split by time.
ENDS_PER_CHUNK = 4096


def with_event_time(df: DataFrame, ts: str, delay: timedelta = timedelta(0)) -> DataFrame:
    """Event time with a watermark ``delay`` behind the latest record (streams only)."""
    return df.withWatermark(ts, as_duration(delay)) if df.isStreaming else df


def window_count(
    df: DataFrame,
    keys: list[str],
    size: timedelta,
    slide: timedelta | None = None,
    ts: str = "ts",
    out: str = "cnt",
    panes: bool = False,
) -> DataFrame:
    """Rows per key and window: ``keys, window_end, out``.  No keys gives a global count.

    A stream counts every row in all windows over it, in append or update mode.  With ``panes``
    it first counts spans of one ``slide`` and then sums closed ones, which is cheaper where
    many windows overlap but gives a window only once it is closed (append mode).  The rows of
    append mode and of a batch are the same either way.
    """
    slide = slide or size
    if slide == size:
        return _direct_count(df, keys, size, slide, ts, out)
    if df.isStreaming:
        if panes and to_us(size) % to_us(slide) == 0:
            return _stream_pane_count(df, keys, size, slide, ts, out)
        return _direct_count(df, keys, size, slide, ts, out)
    if to_us(size) % to_us(slide):
        return _direct_count(df, keys, size, slide, ts, out)
    return _sliding_count(df, keys, size, slide, ts, out)


def window_count_updates(
    df: DataFrame, keys: list[str], size: timedelta, slide: timedelta, ts: str = "ts", out: str = "cnt"
) -> DataFrame:
    """Early and refined sliding counts of a stream, for update mode: ``keys, window_end, out``.

    A micro-batch gives the counts of every window that its rows change, up to the window of
    the latest row of the key; the windows behind it come as they are reached or as the
    watermark closes them.  The last row of a window is that of ``window_count``.  A key has
    one state entry, the counts of the panes of one ``slide`` that an open window covers, so
    neither state nor work grows with ``size / slide`` windows per row.
    """
    if to_us(size) % to_us(slide):
        raise ValueError("size must be a multiple of slide")
    found = stream_panes.window_count_updates(df, keys, to_us(size), to_us(slide), ts, out)
    end = from_epoch_us(F.col("_end"), df.schema[ts].dataType)
    return found.select(*keys, end.alias("window_end"), out)


def _direct_count(df, keys, size, slide, ts, out):
    window = F.window(ts, as_duration(size), as_duration(slide)).alias("w")
    counts = df.groupBy(*keys, window).agg(F.count(F.lit(1)).alias(out))
    return counts.select(*keys, F.col("w.end").alias("window_end"), out)


def _sliding_count(df, keys, size, slide, ts, out):
    """Sliding counts whose cost does not grow with ``size / slide``.

    1. Rows are counted per pane of one slide, partially before the shuffle, so a hot
       key arrives as one row per pane and input task.
    2. A pane raises the count of its key at the first window end that covers it and
       lowers it after the last one: two change rows, however many windows overlap.
       Window ends are cut into chunks no shorter than ``size``, and a pane that reaches
       into the next chunk also raises the count at that chunk's start, so chunks need
       nothing from each other.
    3. A running sum over the changes of a key and chunk gives the count, constant
       between two changes; it is expanded to one row per window end last, after the
       final shuffle.
    """
    slide_us, size_us = to_us(slide), to_us(size)
    span_us = size_us * max(1, ENDS_PER_CHUNK * slide_us // size_us)
    span = timedelta(microseconds=span_us)

    pane = floor_us(epoch_us(F.col(ts)), slide).alias("_pane")
    panes = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("_n"))

    first_end = F.col("_pane") + F.lit(slide_us)
    last_end = F.col("_pane") + F.lit(size_us)
    stop = last_end + F.lit(slide_us)
    first_chunk, last_chunk = floor_us(first_end, span), floor_us(last_end, span)

    def change(chunk, at, delta):
        return F.struct(chunk.alias("_chunk"), at.alias("_at"), delta.alias("_delta"))

    crosses = last_chunk > first_chunk
    changes = F.array(
        change(first_chunk, first_end, F.col("_n")),
        change(first_chunk, stop, -F.col("_n")),
        change(F.when(crosses, last_chunk), last_chunk, F.col("_n")),
        change(F.when(crosses, last_chunk), stop, -F.col("_n")),
    )
    in_chunk = F.col("_chunk").isNotNull() & (F.col("_at") < F.col("_chunk") + F.lit(span_us))
    group = [*keys, "_chunk"]
    steps = (
        panes.select(*keys, F.inline(changes))
        .where(in_chunk)
        .repartition(*group)
        .groupBy(*group, "_at")
        .agg(F.sum("_delta").alias("_delta"))
    )

    by_end = Window.partitionBy(*group).orderBy("_at")
    so_far = by_end.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    until = F.coalesce(F.lead("_at").over(by_end), F.col("_chunk") + F.lit(span_us))
    runs = steps.select(
        *keys, "_at", until.alias("_until"), F.sum("_delta").over(so_far).alias(out)
    ).where(F.col(out) > 0)
    ends = F.sequence("_at", F.col("_until") - F.lit(slide_us), F.lit(slide_us))
    kind = df.schema[ts].dataType
    return runs.select(*keys, F.explode(ends).alias("_end"), out).select(
        *keys, from_epoch_us(F.col("_end"), kind).alias("window_end"), out
    )


def _stream_pane_count(df, keys, size, slide, ts, out):
    """Count panes of one slide, then sum the finished panes per sliding window."""
    pane = F.window(ts, as_duration(slide)).alias("_pane")
    panes = df.groupBy(*keys, pane).agg(F.count(F.lit(1)).alias("_n"))
    window = F.window(F.window_time("_pane"), as_duration(size), as_duration(slide)).alias("w")
    counts = panes.groupBy(*keys, window).agg(F.sum("_n").alias(out))
    return counts.select(*keys, F.col("w.end").alias("window_end"), out)
