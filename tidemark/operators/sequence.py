"""Patterns over the rows of a key in event-time order.

Rows are ordered by ``(ts, seq)``; ``seq`` decides between rows of equal time.  Every
operator selects the few columns it needs before the shuffle and cuts heavy keys into
time slices (``skew``).
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from tidemark.functions import epoch_us, from_epoch_us, to_us
from tidemark.operators.long_runs import sliced_bursts
from tidemark.operators.skew import (
    ROWS_PER_TASK,
    SLICE,
    latest,
    slice_keys,
    with_next_value,
    with_previous,
)
from tidemark.streaming import patterns

ORDER = ["_us", "_seq"]


def strict_sequence(
    df: DataFrame,
    keys: list[str],
    first: Column,
    then: Column,
    within: timedelta,
    ts: str = "ts",
    seq: str = "seq",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Neighbouring rows of a key where ``first`` holds, then ``then``, less than ``within`` apart.

    Gives ``keys, first_ts, last_ts``.  Matches may overlap.
    """
    if df.isStreaming:
        return patterns.strict_sequence(df, keys, first, then, within, ts, seq)
    rows = df.select(
        *keys,
        F.col(seq).alias("_seq"),
        epoch_us(F.col(ts)).alias("_us"),
        F.coalesce(first, F.lit(False)).alias("_first"),
        F.coalesce(then, F.lit(False)).alias("_then"),
    )
    sliced, split = slice_keys(rows, keys, rows_per_task)
    linked = with_previous(sliced, keys, ORDER, ["_us", "_first"], split)
    gap = F.col("_us") - F.col("_prev._us")
    hits = linked.where(F.col("_then") & F.col("_prev._first") & (gap < F.lit(to_us(within))))
    kind = df.schema[ts].dataType
    return hits.select(
        *keys,
        from_epoch_us(F.col("_prev._us"), kind).alias("first_ts"),
        from_epoch_us(F.col("_us"), kind).alias("last_ts"),
    )


def consecutive_pairs(
    df: DataFrame,
    keys: list[str],
    is_fail: Column,
    max_gap: timedelta,
    ts: str = "ts",
    seq: str = "seq",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Two fails of a key in a row, less than ``max_gap`` apart: ``keys, first_ts, last_ts``."""
    return strict_sequence(df, keys, is_fail, is_fail, max_gap, ts, seq, rows_per_task)


def followed_by(
    df: DataFrame,
    keys: list[str],
    first: Column,
    then: Column,
    within: timedelta,
    ts: str = "ts",
    seq: str = "seq",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Every ``first`` row with the nearest later ``then`` row of its key.

    ``kind`` is ``matched`` if that row is less than ``within`` later, else ``timeout``
    with ``then_ts`` NULL.  Gives ``keys, first_ts, then_ts, kind``.
    """
    if df.isStreaming:
        return patterns.followed_by(df, keys, first, then, within, ts, seq)
    us = epoch_us(F.col(ts))
    rows = df.where(first | then).select(
        *keys,
        F.col(seq).alias("_seq"),
        us.alias("_us"),
        F.coalesce(first, F.lit(False)).alias("_first"),
        F.when(then, us).alias("_then"),
    )
    sliced, split = slice_keys(rows, keys, rows_per_task)
    linked = with_next_value(sliced, keys, ORDER, "_then", split)
    in_time = F.col("_next") - F.col("_us") < F.lit(to_us(within))
    kind = df.schema[ts].dataType
    return linked.where("_first").select(
        *keys,
        from_epoch_us(F.col("_us"), kind).alias("first_ts"),
        from_epoch_us(F.when(in_time, F.col("_next")), kind).alias("then_ts"),
        F.when(in_time, "matched").otherwise("timeout").alias("kind"),
    )


def fail_burst(
    df: DataFrame,
    keys: list[str],
    is_fail: Column,
    horizon: timedelta,
    min_count: int = 2,
    ts: str = "ts",
    seq: str = "seq",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Bursts of at least ``min_count`` fails: ``keys, first_ts, last_ts, cnt``.

    A burst is anchored at its first fail and takes the fails up to ``horizon`` after it
    (inclusive).  Any other row up to there (inclusive) discards it, also one after its last
    fail.  The next fail outside opens the next burst.

    A fail after another row, or after a gap longer than ``horizon``, certainly opens a
    burst; the fails up to the next such head form an island, and its first burst is a
    plain aggregate made where the rows already are.  What goes on to the second shuffle
    are bursts and the fails beyond them, which need an unbroken run of fails longer than
    ``horizon``; those are walked in order, in Arrow batches and with constant memory.
    An island of a heavy key may reach through many slices; see ``long_runs``.
    """
    if df.isStreaming:
        return patterns.fail_burst(df, keys, is_fail, horizon, min_count, ts, seq)
    horizon_us = to_us(horizon)
    rows = df.select(
        *keys,
        F.col(seq).alias("_seq"),
        epoch_us(F.col(ts)).alias("_us"),
        F.coalesce(is_fail, F.lit(False)).alias("_fail"),
    )
    rows = rows.withColumn("_other", F.when(~F.col("_fail"), F.col("_us")))
    sliced, split = slice_keys(rows, keys, rows_per_task)
    linked = with_previous(sliced, keys, ORDER, ["_us", "_fail"], split)
    linked = with_next_value(linked, keys, ORDER, "_other", split, "_ends")
    gap = F.col("_us") - F.col("_prev._us")
    continues = F.coalesce(F.col("_prev._fail") & (gap <= F.lit(horizon_us)), F.lit(False))
    heads = F.when(~continues, F.struct(*ORDER)).alias("_head")
    fails = linked.where("_fail").select(*keys, SLICE, *ORDER, "_ends", heads)
    whole = fails.where(F.col(SLICE).isNull()) if split else fails

    in_slice = Window.partitionBy(*keys, SLICE).orderBy(*ORDER)
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    islands = whole.withColumn("_island", latest(F.col("_head")).over(so_far))

    # The first burst of an island becomes one row where the rows already are; fails beyond
    # it stay rows of their own.
    in_first = F.col("_us") <= F.col("_island._us") + F.lit(horizon_us)
    parts = (
        islands.groupBy(*keys, SLICE, "_island", F.when(~in_first, F.struct(*ORDER)).alias("_own"))
        .agg(
            F.min("_us").alias("_from"),
            F.max("_us").alias("_to"),
            F.min("_ends").alias("_ends"),
            F.count(F.lit(1)).alias("cnt"),
        )
        .where(F.col("_own").isNotNull() | (F.col("cnt") >= min_count))
    )
    in_island = Window.partitionBy(*keys, "_island").orderBy("_from", "_own")
    numbered = parts.select(
        *keys, "_from", "_to", "_ends", "cnt", (F.row_number().over(in_island) == 1).alias("_new")
    )
    schema = StructType(
        [rows.schema[k] for k in keys]
        + [StructField(name, LongType()) for name in ("_from", "_to", "_ends", "cnt")]
    )
    bursts = numbered.mapInArrow(_burst_walker(keys, horizon_us), schema)
    if split:
        opened = fails.where(F.col(SLICE).isNotNull()).withColumn("_opens", F.col("_head").isNotNull())
        bursts = bursts.unionByName(sliced_bursts(opened.drop("_head"), keys, horizon_us))
    kind = df.schema[ts].dataType
    cancelled = F.coalesce(F.col("_ends") <= F.col("_from") + F.lit(horizon_us), F.lit(False))
    return (
        bursts.where((F.col("cnt") >= min_count) & ~cancelled)
        .select(
            *keys,
            from_epoch_us(F.col("_from"), kind).alias("first_ts"),
            from_epoch_us(F.col("_to"), kind).alias("last_ts"),
            "cnt",
        )
    )


def _burst_walker(keys: list[str], horizon_us: int):
    """Join the sorted parts of islands into bursts; ``_new`` marks the first part of an island.

    The open burst is the only thing kept between batches.  ``_ends``, the next row that is
    no fail, is the same for all parts of an island.
    """
    values = ["_from", "_to", "_ends", "cnt"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, burst = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            result = batch.select([*keys, *values])
            schema = result.schema
            first, last, cnt = (batch.column(name).to_numpy() for name in ("_from", "_to", "cnt"))
            new = batch.column("_new").to_numpy(zero_copy_only=False)
            so_far = np.concatenate(([0], cnt.cumsum()))
            bounds = np.unique(np.concatenate(([0], np.flatnonzero(new), [batch.num_rows])))
            starts, ends = bounds[:-1], bounds[1:]
            # An island of one part is a burst already; the last may go on in the next batch.
            alone = (ends - starts == 1) & (ends < batch.num_rows) & new[starts]
            yield result.take(pa.array(starts[alone]))
            done = []
            for at, end in zip(starts[~alone].tolist(), ends[~alone].tolist()):
                if not new[at]:
                    # The island goes on from the batch before: extend its open burst.
                    at = int(first[:end].searchsorted(burst["_from"] + horizon_us, "right"))
                    if at:
                        burst["_to"] = int(last[at - 1])
                        burst["cnt"] += int(so_far[at])
                while at < end:
                    if burst:
                        done.append(burst)
                    reach = at + int(first[at:end].searchsorted(first[at] + horizon_us, "right"))
                    burst = {k: batch.column(k)[at].as_py() for k in [*keys, "_ends"]}
                    burst["_from"], burst["_to"] = int(first[at]), int(last[reach - 1])
                    burst["cnt"] = int(so_far[reach] - so_far[at])
                    at = reach
            yield pa.RecordBatch.from_pylist(done, schema)
        if burst:
            yield pa.RecordBatch.from_pylist([burst], schema)

    return walk
