"""Distinct counts from sketches that can be stored, merged and rolled up."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import as_duration

# A sketch has 2 ** BITS registers: a relative deviation of about 1.04 / 2 ** (BITS / 2).
BITS = 12


def window_sketches(
    df: DataFrame, col: str, size: timedelta, keys: list[str] = (), ts: str = "ts", bits: int = BITS
) -> DataFrame:
    """``keys, window_end, sketch`` of the values of ``col`` per tumbling window, batch or stream."""
    window = F.window(ts, as_duration(size)).alias("w")
    sketches = df.groupBy(*keys, window).agg(F.hll_sketch_agg(col, bits).alias("sketch"))
    return sketches.select(*keys, F.col("w.end").alias("window_end"), "sketch")


def roll_up(sketches: DataFrame, size: timedelta, keys: list[str] = ()) -> DataFrame:
    """The sketches of longer windows, or with fewer ``keys``, from stored ones.

    ``size`` must be a multiple of that of the given windows.  No event is read again, and a
    task merges sketches of fixed size, whatever number of values they have seen.
    """
    inside = F.col("window_end") - F.expr("interval 1 microsecond")
    window = F.window(inside, as_duration(size)).alias("w")
    merged = sketches.groupBy(*keys, window).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*keys, F.col("w.end").alias("window_end"), "sketch")


def sketched_counts(sketches: DataFrame, out: str = "uv") -> DataFrame:
    """The number of distinct values each sketch has seen, in place of the sketch."""
    others = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*others, F.hll_sketch_estimate("sketch").alias(out))
