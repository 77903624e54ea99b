"""Mixing sources to target weights by weighted fair queueing.

Every source shuffles its documents by a hash.  A document's virtual finish time is the tokens
of its source up to and including it, divided by the source's target; a source that must repeat
goes on counting through further passes.  All documents are sorted by finish time across sources
and the queue is cut at the total budget.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import stored

WEIGHTS = (1.0, 2.0, 3.0)
MOST_PASSES = 3


def word_count(text: Column) -> Column:
    """Runs of characters other than space and U+0009-U+000D; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(
    sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, passes: int = MOST_PASSES
) -> DataFrame:
    """``source``, ``source_size``, ``target`` for rows of ``source``, ``size``.

    The sources, by code point with null last, take the weights in turn and share the sum of all
    sizes; a target stops at ``passes`` times its source's size and the excess is shared anew by
    weight.  So all unlimited sources stand at one level of target over weight.  With the sources
    ordered by size over weight, the level that is left once the first few are full rises as long
    as the next is full too and falls afterwards: the largest is the one.  One row per source
    passes a single task.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    by_limit = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before, everything = by_limit.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    turn = F.array(*map(F.lit, weights))
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("weight", F.get(turn, (F.row_number().over(by_name) - 1) % len(weights)))
    filled = passes * F.coalesce(F.sum("source_size").over(before), F.lit(0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (F.sum("source_size").over(everything) - filled) / open_weight
    levels = ranked.select("source", "source_size", "weight", level.alias("level"))
    water = F.max("level").over(everything)
    target = F.least(water * F.col("weight"), (passes * F.col("source_size")).cast("double"))
    return levels.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def running_total(rows: DataFrame, order: list[str], value: str, within: list[str], label: str) -> DataFrame:
    """``rows`` with ``so_far``: the sum of ``value`` up to and including the row, in the order of
    ``within`` + ``order``, for each ``within``.

    The rows are range-sorted into slices, each slice is summed, and a row adds the sums of the
    slices before its own; so one large group is shared by many tasks.  The sorted slices are
    stored, because slice borders may differ when they are computed again.
    """
    spark = rows.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    dealt = rows.repartitionByRange(parts, *within, *order).withColumn("_slice", F.spark_partition_id())
    dealt = stored(dealt, label)
    earlier = Window.partitionBy(*within).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy(*within, "_slice").agg(F.sum(value).alias("_sum"))
    starts = sums.select(
        F.col("_slice").alias("_of_slice"),
        *[F.col(c).alias(f"_of_{c}") for c in within],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
    )
    inside = Window.partitionBy("_slice", *within).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = dealt.withColumn("_local", F.sum(value).over(inside))
    same = [F.col("_slice") == F.col("_of_slice"), *[F.col(c).eqNullSafe(F.col(f"_of_{c}")) for c in within]]
    joined = local.join(starts, same, "left")
    return joined.select(*rows.columns, (F.col("_local") + F.col("_start")).alias("so_far"))


def fair_queue(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    passes: int = MOST_PASSES,
    seed: str = "mix",
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``size``, ``source_size``, ``target``, ``taken``.

    ``size`` counts words and ``taken`` the words the mix takes, whole documents up to ``passes``
    times each; ``target`` is that of the row's source.  The order of a source is the hash of
    ``seed`` and id, ties by id and size.  A document whose words reach beyond the budget is not
    taken, so what all sources take falls short of the budget by less than one document.  A null
    source is a source, a null text has no words, and a table without words takes none.
    Repeated rows count as often as they stand there.
    """
    sized = docs.select(
        F.col(id_col).alias("doc_id"),
        F.col(source_col).alias("source"),
        word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")))).alias("place"),
    )
    queued = running_total(sized, ["place", "doc_id", "size"], "size", ["source"], "mix-sources")
    targets = source_targets(queued, weights, passes)
    # One row per source: the planner broadcasts it where its size is known to be small.
    timed = queued.join(
        targets.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left"
    ).drop("_source")
    timed = timed.withColumn("row", F.monotonically_increasing_id())
    turns = timed.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    words = F.col("turn") * F.col("source_size") + F.col("so_far")
    finish = F.when(F.col("target") > 0, words / F.col("target")).otherwise(F.lit(0.0))
    line = turns.select("doc_id", "place", "size", "source_size", "target", "turn", "row", finish.alias("finish"))
    served = running_total(line, ["finish", "place", "doc_id", "size", "turn", "row"], "size", [], "mix-queue")
    budget = targets.agg(F.sum("source_size")).scalar()
    took = F.when(F.col("so_far") <= budget, F.col("size")).otherwise(F.lit(0))
    return (
        served.groupBy("row", "doc_id", "size", "source_size", "target")
        .agg(F.sum(took).alias("taken"))
        .drop("row")
    )
