"""Per-key caps with a warning output."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import epoch_us, floor_us
from tidemark.functions.times import DAY
from tidemark.streaming import patterns

SLOTS_PER_PERIOD = 1440
LIMIT_CONF = "spark.sql.optimizer.windowGroupLimitThreshold"


def click_cap(
    df: DataFrame,
    keys: list[str],
    cap: int,
    ts: str = "ts",
    seq: str = "seq",
    inclusive: bool = False,
    period: timedelta = DAY,
) -> DataFrame:
    """Rows with ``kind``: ``pass`` up to the cap, one ``warn`` row at the first row beyond it.

    Later rows of the key are dropped until the next ``period``.  The cap test is
    "more than ``cap`` seen before", so ``cap + 1`` rows pass; ``inclusive`` lets exactly
    ``cap`` pass.

    Only the first ``cap + 2`` rows of a key matter and Spark cuts the others away in
    every task before the shuffle, so a key holding most of the rows stays small.
    """
    passes = cap if inclusive else cap + 1
    if df.isStreaming:
        return patterns.click_cap(df, keys, passes, period, ts, seq)
    limit = passes + 1
    rows = df.withColumn("_period", floor_us(epoch_us(F.col(ts)), period))
    part = [*keys, "_period"]
    if limit > int(df.sparkSession.conf.get(LIMIT_CONF, "1000")):
        # Beyond this Spark does not cut before the shuffle: first cut inside short slots.
        slot = floor_us(epoch_us(F.col(ts)), period / SLOTS_PER_PERIOD)
        rows = _first_rows(rows.withColumn("_slot", slot), [*part, "_slot"], ts, seq, limit)
        rows = rows.drop("_slot")
    kept = _first_rows(rows, part, ts, seq, limit)
    kind = F.when(F.col("_rn") <= passes, "pass").otherwise("warn")
    return kept.select(*df.columns, kind.alias("kind"))


def _first_rows(df, part, ts, seq, limit):
    order = Window.partitionBy(*part).orderBy(ts, seq)
    return df.withColumn("_rn", F.row_number().over(order)).where(F.col("_rn") <= limit)
