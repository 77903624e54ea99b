"""Deadlines: rows that must be followed by another row of their key in time."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import as_duration, epoch_us, from_epoch_us, to_us
from tidemark.operators.skew import (
    ROWS_PER_TASK,
    SLICE,
    join_small,
    slice_keys,
    with_next_value,
)
from tidemark.streaming import patterns


def missing_follow_up(
    df: DataFrame,
    keys: list[str],
    first: Column,
    then: Column,
    deadline: timedelta,
    lookback: timedelta | None = None,
    ts: str = "ts",
    seq: str = "seq",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """``first`` rows without a ``then`` row of their key before ``ts + deadline``.

    An earlier ``then`` row also counts, at most ``lookback`` before if one is given.
    Gives ``keys, first_ts``.  ``first`` and ``then`` exclude each other.  A stream needs
    a ``lookback``, else no ``then`` row could ever be forgotten.
    """
    if df.isStreaming:
        return _stream_missing(df, keys, first, then, deadline, lookback, ts)
    us, deadline_us = epoch_us(F.col(ts)), to_us(deadline)
    kind = df.schema[ts].dataType
    start, paid = F.when(first, us), F.when(then, us)
    rows = df.where(first | then).select(
        *keys,
        us.alias("_us"),
        F.coalesce(then, F.lit(False)).cast("int").alias("_side"),
        F.col(seq).alias("_seq"),
        start.alias("_start"),
        paid.alias("_then"),
    )
    if lookback is None:
        # The earliest follow-up of the key decides.
        sliced, split = slice_keys(rows, keys, rows_per_task)
        group = Window.partitionBy(*keys, SLICE)
        linked = sliced.withColumn("_paid", F.min("_then").over(group))
        if split:
            heavy = sliced.where(F.col(SLICE).isNotNull())
            earliest = heavy.groupBy(*keys).agg(F.min("_then").alias("_earliest"))
            linked = join_small(linked, earliest, keys)
            linked = linked.withColumn("_paid", F.coalesce("_earliest", "_paid"))
    else:
        # A follow-up in time is the first one at or after start - lookback, so starts
        # are placed there and look forward.
        placed = rows.withColumn("_us", F.coalesce(F.col("_start") - F.lit(to_us(lookback)), "_us"))
        sliced, split = slice_keys(placed, keys, rows_per_task)
        linked = with_next_value(sliced, keys, ["_us", "_side", "_seq"], "_then", split, "_paid")
    open_ = linked.where(F.col("_start").isNotNull())
    late = F.col("_paid").isNull() | (F.col("_paid") >= F.col("_start") + F.lit(deadline_us))
    return open_.where(late).select(*keys, from_epoch_us(F.col("_start"), kind).alias("first_ts"))


def _stream_missing(df, keys, first, then, deadline, lookback, ts):
    """Outer interval join of the stream with itself; the watermark decides what is missing."""
    if lookback is None:
        raise ValueError("a streaming missing_follow_up needs a lookback")
    starts = df.where(first).select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(ts).alias("first_ts"))
    paid = df.where(then).select(*keys, F.col(ts).alias("_paid"))
    on = [F.col(f"_{k}").eqNullSafe(F.col(k)) for k in keys]
    on.append(F.col("_paid") >= F.col("first_ts") - F.expr(f"interval {as_duration(lookback)}"))
    on.append(F.col("_paid") < F.col("first_ts") + F.expr(f"interval {as_duration(deadline)}"))
    joined = starts.join(paid, on, "left_outer").where(F.col("_paid").isNull())
    return joined.select(*[F.col(f"_{k}").alias(k) for k in keys], "first_ts")


def lifecycle_status(
    df: DataFrame,
    keys: list[str],
    first: Column,
    then: Column,
    deadline: timedelta,
    ts: str = "ts",
    seq: str = "seq",
    wait: timedelta | None = None,
    keep: timedelta = timedelta(days=30),
) -> DataFrame:
    """Exactly one ``status`` per key: ``paid``, ``timeout`` or ``no_create``.

    ``paid`` needs a ``then`` row before the first ``first`` row plus ``deadline`` (also
    one that comes earlier), ``timeout`` has none in time and ``no_create`` has no
    ``first`` row.  One aggregate with partial sums before the shuffle.
    Gives ``keys, create_ts, pay_ts, status``; ``pay_ts`` is NULL for ``timeout``.

    With a ``wait`` only the rows less than that after the first row of a key count.  A
    stream needs one: then it stops waiting for a ``first`` row, and keeps a mark of the
    key so that rows that come later change nothing.  The mark goes ``keep`` after the
    ``wait``; a row that comes later still begins the key anew.
    """
    if wait is not None and wait < deadline:
        raise ValueError("wait must not be shorter than the deadline")
    if df.isStreaming:
        if wait is None:
            raise ValueError("a streaming lifecycle_status needs a wait")
        return patterns.lifecycle_status(df, keys, first, then, deadline, wait, keep, ts, seq)
    us = epoch_us(F.col(ts))
    per_key = (
        df.where(first | then)
        .groupBy(*keys)
        .agg(F.min(F.when(first, us)).alias("_create"), F.min(F.when(then, us)).alias("_pay"))
    )
    if wait is not None:
        end = F.least("_create", "_pay") + F.lit(to_us(wait))
        per_key = per_key.withColumn("_end", end).select(
            *keys, *[F.when(F.col(c) < F.col("_end"), F.col(c)).alias(c) for c in ("_create", "_pay")]
        )
    in_time = F.col("_pay") < F.col("_create") + F.lit(to_us(deadline))
    status = (
        F.when(F.col("_create").isNull(), "no_create").when(in_time, "paid").otherwise("timeout")
    )
    kind = df.schema[ts].dataType
    return per_key.select(
        *keys,
        from_epoch_us(F.col("_create"), kind).alias("create_ts"),
        from_epoch_us(F.when(status != "timeout", F.col("_pay")), kind).alias("pay_ts"),
        status.alias("status"),
    )
