"""Ranking inside each window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.streaming import ranking


def top_n(
    counts: DataFrame,
    n: int,
    tie: str,
    cnt: str = "cnt",
    window_end: str = "window_end",
) -> DataFrame:
    """The ``n`` largest counts per window with their ``rank``; equal counts by ``tie`` ascending.

    The filter on the row number lets Spark keep only ``n`` rows per window in every
    task before the shuffle, so a window with very many keys does not meet in one task.

    On a stream of counts with a watermark on ``window_end`` it gives the ranks that change, for
    update mode; a count that comes again, larger, replaces the old one.  Counts that one query
    makes and ranks go through ``streaming.write_top_n``.
    """
    if counts.isStreaming:
        return ranking.top_n(counts, n, tie, cnt, window_end)
    ranked = Window.partitionBy(window_end).orderBy(F.col(cnt).desc(), F.col(tie))
    return counts.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)
