"""Reconciliation of two event tables: a one-to-one full outer interval match."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import epoch_us, to_us
from tidemark.operators.skew import (
    ROWS_PER_TASK,
    SLICE,
    join_small,
    latest,
    slice_keys,
    slices_before,
    summarise,
    with_previous,
)
from tidemark.streaming import patterns


def reconcile(
    left: DataFrame,
    right: DataFrame,
    key: str,
    tolerance: timedelta,
    ts: str = "ts",
    seq: str = "seq",
    rows_per_task: int | None = ROWS_PER_TASK,
) -> DataFrame:
    """Match rows of equal ``key`` at most ``tolerance`` apart; warn about the others.

    Gives ``key, kind, left, right`` with ``kind`` one of ``matched``, ``left_only`` and
    ``right_only`` and the rows as structs.  Every row appears exactly once: in time
    order a row takes the row just before it if that is of the other side, near enough
    and not yet taken, as with one pending row per key.  So a key with many rows on both
    sides gives no product of them, and both tables are shuffled once, together.
    """
    if left.isStreaming:
        return patterns.reconcile(left, right, key, tolerance, ts, seq)
    sides = _side(left, key, ts, seq, 0).unionByName(
        _side(right, key, ts, seq, 1), allowMissingColumns=True
    )
    keys, order = [key], ["_us", "_side", "_seq"]
    sliced, split = slice_keys(sides, keys, rows_per_task)
    linked = with_previous(sliced, keys, order, ["_us", "_side"], split)

    # A chain is a run of alternating sides without a long gap.  Its rows pair up from
    # its first row on, so a row takes the one before iff its side is not the first's.
    chained = (
        F.col(key).isNotNull()
        & (F.col("_side") != F.col("_prev._side"))
        & (F.col("_us") - F.col("_prev._us") <= F.lit(to_us(tolerance)))
    )
    chains = linked.withColumn(
        "_opens", F.when(~F.coalesce(chained, F.lit(False)), F.col("_side"))
    )
    in_slice = Window.partitionBy(key, SLICE).orderBy(*order)
    so_far = in_slice.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    chains = chains.withColumns(
        {
            "_start": latest(F.col("_opens")).over(so_far),
            "_before": F.lag(F.struct("left", "right")).over(in_slice),
        }
    )
    if split:
        chains = join_small(chains, _across(chains, keys, order), [key, SLICE])
        chains = chains.withColumn("_start", F.coalesce("_start", "_start_before"))
        chains = _with_rows_before_slices(chains, sliced, key, order, in_slice)
    takes = F.col("_opens").isNull() & (F.col("_side") != F.col("_start"))
    paired = chains.withColumn("_takes", takes)
    taken = F.lead("_takes").over(in_slice)
    if split:
        taken = F.coalesce(taken, F.col("_taken_after"))
    paired = paired.withColumn("_taken", F.coalesce(taken, F.lit(False)))

    alone = F.when(F.col("_side") == 0, "left_only").otherwise("right_only")
    return paired.where(~F.col("_taken")).select(
        key,
        F.when(F.col("_takes"), "matched").otherwise(alone).alias("kind"),
        F.coalesce("left", F.when(F.col("_takes"), F.col("_before.left"))).alias("left"),
        F.coalesce("right", F.when(F.col("_takes"), F.col("_before.right"))).alias("right"),
    )


def _with_rows_before_slices(chains, sliced, key, order, in_slice):
    """Give the first row of a slice the last row of the slice before, as ``_before``.

    Whole rows may be of any size, so they are not broadcast: one per slice is sent to the
    task of the next slice, by the partitioning that ``chains`` has already.
    """
    lasts = sliced.where(F.col(SLICE).isNotNull()).groupBy(key, SLICE)
    lasts = lasts.agg(F.max_by(F.struct("left", "right"), F.struct(*order)).alias("_last"))
    by_slice = Window.partitionBy(key).orderBy(SLICE)
    sent = lasts.select(
        F.col(key).alias("_to_key"), F.lead(SLICE).over(by_slice).alias("_to_slice"), "_last"
    ).where("_to_slice IS NOT NULL")
    placed = chains.withColumn("_place", F.row_number().over(in_slice))
    # A NULL key matches nothing, so plain equality will do; the first row of a slice asks.
    same = (F.col(key) == F.col("_to_key")) & (F.col(SLICE) == F.col("_to_slice"))
    joined = placed.join(sent.hint("merge"), same & (F.col("_place") == 1), "left")
    joined = joined.drop("_to_key", "_to_slice")
    return joined.withColumn("_before", F.coalesce("_before", "_last")).drop("_last", "_place")


def _side(df, key, ts, seq, side):
    return df.select(
        key,
        epoch_us(F.col(ts)).alias("_us"),
        F.lit(side).alias("_side"),
        F.col(seq).alias("_seq"),
        F.struct(*df.columns).alias("right" if side else "left"),
    )


def _across(chains, keys, order):
    """Per slice: the side that opened the running chain, and whether its last row is taken."""
    position = F.struct(*order)
    summary = summarise(
        chains,
        keys,
        F.max_by("_opens", F.when(F.col("_opens").isNotNull(), position)).alias("_last_open"),
        F.min_by(F.struct("_side", "_opens"), position).alias("_head"),
    )
    before = latest(F.col("_last_open")).over(slices_before(keys))
    started = summary.select(*keys, SLICE, "_head", before.alias("_start_before"))
    head_takes = F.col("_head._opens").isNull() & (
        F.col("_head._side") != F.col("_start_before")
    )
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    return started.select(
        *keys, SLICE, "_start_before", F.lead(head_takes).over(by_slice).alias("_taken_after")
    )
