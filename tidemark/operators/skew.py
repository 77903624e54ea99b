"""Splitting keys that hold too many rows for one task.

Operators that read the rows of a key in time order put the key in one task group.
That is fine for ordinary keys.  A heavy key is cut into time slices, each its own
group, and what a slice needs from the slices around it is taken from a small summary
with one row per slice.

One pass over a sample of the rows finds the heavy keys and, from a quantile sketch of
their times, slices of about equal numbers of rows, wherever in time the rows lie.
Only the ``MAX_HEAVY_KEYS`` largest keys are cut, which covers every key above
``1 / MAX_HEAVY_KEYS`` of all rows, and into at most ``3 * MAX_HEAVY_KEYS`` slices,
whatever the input.  Summaries hold fields of fixed size only, so both tables have a
fixed bound and are broadcast.  Without a heavy key the plan has neither.

A slice ends between two instants, so rows of one key and one instant stay together.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

# A key with at most this many rows is always left whole.
ROWS_PER_TASK = 1_000_000

MAX_HEAVY_KEYS = 20_000

# Slices aim at half of the rows a task may have; a key has at most as many as the sketch
# has quantiles.
SLICES_PER_LIMIT = 2
QUANTILES = 4096

# Rows looked at for every ``rows_per_task`` rows: counts are right to about two in a hundred.
SAMPLED_PER_LIMIT = 2048

SLICE = "_slice"


def slice_keys(
    df: DataFrame, keys: list[str], rows_per_task: int | None = ROWS_PER_TASK, at: str = "_us"
) -> tuple[DataFrame, bool]:
    """Add ``_slice``, rising with ``at`` for rows of heavy keys and else NULL.

    Also tells whether there is any heavy key.  ``rows_per_task=None`` skips the search
    when keys are known to be small.
    """
    heavy = rows_per_task and _heavy_keys(df, keys, rows_per_task, at)
    if not heavy:
        return df.withColumn(SLICE, F.lit(None).cast("bigint")), False
    sliced = join_small(df, heavy, keys).withColumn(SLICE, _bounds_up_to(F.col(at)))
    return sliced.drop("_bounds"), True


def _heavy_keys(df, keys, rows_per_task, at):
    """The largest keys with the times at which their slices begin, or None."""
    one_in = max(1, rows_per_task // SAMPLED_PER_LIMIT)
    sample = df.where(F.rand(17) * one_in < 1) if one_in > 1 else df
    shares = [k / QUANTILES for k in range(1, QUANTILES)]
    counts = sample.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.percentile_approx(at, shares).alias("_at")
    )
    largest = counts.where(F.col("_n") > rows_per_task // one_in).orderBy(F.col("_n").desc())
    found = largest.limit(MAX_HEAVY_KEYS).collect()
    if not found:
        return None
    limit = max(rows_per_task / one_in, sum(row["_n"] for row in found) / MAX_HEAVY_KEYS)
    rows = []
    for *key, n, quantiles in found:
        slices = min(QUANTILES, -int(-n * SLICES_PER_LIMIT // limit))
        picked = {quantiles[k * QUANTILES // slices - 1] for k in range(1, slices)}
        rows.append((*key, sorted(picked)))
    schema = StructType([df.schema[k] for k in keys] + [StructField("_bounds", ArrayType(LongType()))])
    return df.sparkSession.createDataFrame(rows, schema)


def _bounds_up_to(value: Column) -> Column:
    """How many of the sorted ``_bounds`` are not above ``value``; NULL without bounds."""

    def further(found, step):
        reached = F.get("_bounds", found + step - F.lit(1)) <= value
        return F.when(F.coalesce(reached, F.lit(False)), found + step).otherwise(found)

    steps = [QUANTILES >> k for k in range(QUANTILES.bit_length())]
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), further)
    return F.when(F.col("_bounds").isNotNull(), found.cast("bigint"))


def join_small(df: DataFrame, small: DataFrame, on: list[str]) -> DataFrame:
    """Left join to a broadcast table of bounded size; NULL keys match each other."""
    renamed = small.select(
        *[F.col(c).alias(f"_on_{c}") for c in on], *[c for c in small.columns if c not in on]
    )
    same = reduce(
        lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on]
    )
    return df.join(F.broadcast(renamed), same, "left").drop(*[f"_on_{c}" for c in on])


def summarise(sliced: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """One row per slice of the heavy keys."""
    return sliced.where(F.col(SLICE).isNotNull()).groupBy(*keys, SLICE).agg(*aggregates)


def slices_before(keys: list[str]):
    """Frame over a summary: all earlier slices of the key."""
    by_slice = Window.partitionBy(*keys).orderBy(SLICE)
    return by_slice.rowsBetween(Window.unboundedPreceding, -1)


def slices_after(keys: list[str]):
    """Frame over a summary: all later slices of the key, nearest last."""
    by_slice = Window.partitionBy(*keys).orderBy(F.col(SLICE).desc())
    return by_slice.rowsBetween(Window.unboundedPreceding, -1)


def latest(value: Column) -> Column:
    return F.last(value, ignorenulls=True)


def with_previous(
    sliced: DataFrame,
    keys: list[str],
    order: list[str],
    values: list[str],
    split: bool,
    out: str = "_prev",
) -> DataFrame:
    """Add the struct ``out`` of ``values`` from the row before, across slices."""
    row = F.struct(*values)
    in_slice = Window.partitionBy(*keys, SLICE).orderBy(*order)
    local = sliced.withColumn(out, F.lag(row).over(in_slice))
    if not split:
        return local
    tails = summarise(sliced, keys, F.max_by(row, F.struct(*order)).alias("_tail"))
    carry = tails.select(*keys, SLICE, latest(F.col("_tail")).over(slices_before(keys)).alias("_tail"))
    joined = join_small(local, carry, [*keys, SLICE])
    return joined.withColumn(out, F.coalesce(out, "_tail")).drop("_tail")


def with_next_value(
    sliced: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    split: bool,
    out: str = "_next",
) -> DataFrame:
    """Add ``out``: the nearest later non-NULL ``value`` of the key, across slices.

    The frame runs backwards in time: Spark extends a frame that starts at the first
    row step by step, but recomputes one that ends at the last row for every row.
    """
    backwards = Window.partitionBy(*keys, SLICE).orderBy(*[F.col(c).desc() for c in order])
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    local = sliced.withColumn(out, latest(F.col(value)).over(later))
    if not split:
        return local
    position = F.when(F.col(value).isNotNull(), F.struct(*order))
    per_slice = summarise(sliced, keys, F.min_by(value, position).alias("_after"))
    carry = per_slice.select(
        *keys, SLICE, latest(F.col("_after")).over(slices_after(keys)).alias("_after")
    )
    joined = join_small(local, carry, [*keys, SLICE])
    return joined.withColumn(out, F.coalesce(out, "_after")).drop("_after")
