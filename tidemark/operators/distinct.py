"""Distinct visitors per window: exact, approximate and running."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import as_duration, epoch_us, floor_us, from_epoch_us, to_us
from tidemark.streaming import visitors

# Slots a window is cut into for the running count; each is one task group.
SLOTS_PER_WINDOW = 1440


def window_distinct(
    df: DataFrame, col: str, size: timedelta, ts: str = "ts", out: str = "uv"
) -> DataFrame:
    """Exact distinct values of ``col`` per tumbling window."""
    window = F.window(ts, as_duration(size)).alias("w")
    if df.isStreaming:
        seen = df.select(window, F.col(col).alias("_value")).dropDuplicates(["w", "_value"])
        counts = seen.groupBy("w").agg(F.count("_value").alias(out))
    else:
        counts = df.groupBy(window).agg(F.count_distinct(col).alias(out))
    return counts.select(F.col("w.end").alias("window_end"), out)


def window_approx_distinct(
    df: DataFrame,
    col: str,
    size: timedelta,
    rsd: float = 0.05,
    ts: str = "ts",
    out: str = "uv",
) -> DataFrame:
    """Approximate distinct values per tumbling window, relative deviation ``rsd``."""
    window = F.window(ts, as_duration(size)).alias("w")
    counts = df.groupBy(window).agg(F.approx_count_distinct(col, rsd).alias(out))
    return counts.select(F.col("w.end").alias("window_end"), out)


def running_distinct(
    df: DataFrame,
    col: str,
    size: timedelta,
    ts: str = "ts",
    seq: str = "seq",
    slots: int = SLOTS_PER_WINDOW,
) -> DataFrame:
    """Every row with ``window_end``, ``uv`` (distinct values so far in its window) and ``is_new``.

    Rows count in ``(ts, seq)`` order, which must be unique.  Neither a window nor a
    value is gathered in one task: the first row of each value and window is found by
    an aggregate, a window is cut into time ``slots``, and a slot starts from the
    number of first rows before it.  First rows and starting numbers join the events as
    marker rows, so the events are shuffled once.

    A stream gives a row once the watermark has passed it, with the same numbers.
    """
    if df.isStreaming:
        return visitors.running_distinct(df, col, to_us(size), ts, seq)
    size_us = to_us(size)
    step = timedelta(microseconds=max(1, -(-size_us // slots)))
    step_us = to_us(step)

    def slot_of(us):
        return F.col("_start") + floor_us(us - F.col("_start"), step)

    us = epoch_us(F.col(ts))
    events = df.withColumn("_us", us).withColumn("_start", floor_us(F.col("_us"), size))
    events = events.withColumn("_slot", slot_of(F.col("_us")))

    firsts = events.groupBy("_start", col).agg(F.min(F.struct("_us", seq)).alias("_first"))
    marks = firsts.where(F.col(col).isNotNull()).select(
        "_start", F.col("_first._us").alias("_us"), F.col(f"_first.{seq}").alias(seq)
    )
    marks = marks.withColumn("_slot", slot_of(F.col("_us")))

    by_slot = Window.partitionBy("_start").orderBy("_slot")
    following = F.coalesce(
        F.lead("_slot").over(by_slot), F.col("_start") + floor_us(F.lit(size_us - 1), step)
    )
    totals = (
        marks.groupBy("_start", "_slot")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            "_start",
            (F.col("_slot") + F.lit(step_us)).alias("_from"),
            following.alias("_to"),
            F.sum("_n").over(by_slot).alias("_add"),
        )
        .where(F.col("_from") <= F.col("_to"))
    )
    carried = totals.select(
        "_start", F.explode(F.sequence("_from", "_to", F.lit(step_us))).alias("_slot"), "_add"
    )

    def marker(rows, kind, add):
        return rows.withColumns({"_kind": F.lit(kind), "_add": add.cast("bigint")})

    placed = events.select("_start", "_slot", "_us", seq, F.struct(*df.columns).alias("_row"))
    rows = marker(placed, 2, F.lit(0))
    for markers in (
        marker(marks, 1, F.lit(1)),
        marker(carried.withColumn("_us", F.col("_slot")), 0, F.col("_add")),
    ):
        rows = rows.unionByName(markers, allowMissingColumns=True)
    in_slot = Window.partitionBy("_start", "_slot")
    order = in_slot.orderBy("_us", F.col(seq).asc_nulls_first(), "_kind")
    counted = rows.select(
        "_row",
        "_kind",
        (F.col("_start") + F.lit(size_us)).alias("_end"),
        F.sum("_add").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("uv"),
        F.coalesce(F.lag("_kind").over(order) == 1, F.lit(False)).alias("is_new"),
    ).where(F.col("_kind") == 2)
    return counted.select(
        "_row.*",
        from_epoch_us(F.col("_end"), df.schema[ts].dataType).alias("window_end"),
        "uv",
        "is_new",
    )


def running_distinct_updates(
    df: DataFrame, col: str, size: timedelta, ts: str = "ts", out: str = "uv"
) -> DataFrame:
    """Streaming form of the running count, for update mode.

    Each micro-batch emits the refined count of every window it changed; the state
    keeps one entry per window and value and is dropped behind the watermark.
    """
    return window_distinct(df, col, size, ts, out)
