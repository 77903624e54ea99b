"""Times some catalog queries next to the obvious plain-Spark form of each.

BENCH_SF_DIR and BENCH_CPUS as in ``bench.py``; BENCH_QUERIES picks queries.  Prints one line
per query: name, plain seconds, library seconds (best of two warm runs each).
"""

from __future__ import annotations

import os
from datetime import timedelta

from pyspark.sql import Window
from pyspark.sql import functions as F

from bench import timed
from tidemark.plans import catalog
from tidemark.plans.catalog import DAY, events, is_create, is_error, is_pay, table, views
from tidemark.session import build_session


def hot_items_topn(spark, path):
    window = F.window("ts", "6 hours", "1 hour").alias("w")
    counts = views(spark, path).groupBy("k", window).agg(F.count("*").alias("cnt"))
    order = Window.partitionBy("w").orderBy(F.col("cnt").desc(), "k")
    return counts.withColumn("rank", F.row_number().over(order)).where("rank <= 3")


def running_unique_visitors(spark, path):
    rows = views(spark, path).withColumn("w", F.window("ts", "1 day"))
    first = Window.partitionBy("w", "user_id").orderBy("ts", "seq")
    so_far = Window.partitionBy("w").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("is_new", F.row_number().over(first) == 1)
    return marked.withColumn("uv", F.sum(F.col("is_new").cast("int")).over(so_far))


def consecutive_fail_pairs(spark, path):
    order = Window.partitionBy("user_id").orderBy("ts", "seq")
    rows = events(spark, path).withColumn("error", is_error())
    linked = rows.withColumn("prev", F.lag(F.struct("ts", "error")).over(order))
    gap = F.col("ts") - F.col("prev.ts")
    return linked.where(F.col("error") & F.col("prev.error") & (gap < timedelta(hours=12)))


def create_pay_match(spark, path):
    creates = events(spark, path).where(is_create()).select("user_id", "seq", "ts")
    pays = events(spark, path).where(is_pay()).select("user_id", F.col("ts").alias("pay_ts"))
    near = (F.col("pay_ts") > F.col("ts")) & (F.col("pay_ts") < F.col("ts") + F.lit(DAY))
    joined = creates.join(pays, "user_id").where(near)
    return joined.groupBy("user_id", "seq", "ts").agg(F.min("pay_ts").alias("pay_ts"))


def unpaid_orders_lookback(spark, path):
    creates = events(spark, path).where(is_create()).select("user_id", "ts")
    pays = events(spark, path).where(is_pay()).select(
        F.col("user_id").alias("payer"), F.col("ts").alias("pay_ts")
    )
    near = (F.col("pay_ts") >= F.col("ts") - F.lit(DAY)) & (F.col("pay_ts") < F.col("ts") + F.lit(DAY))
    return creates.join(pays, (F.col("payer") == F.col("user_id")) & near, "left_anti")


def reconcile_matched(spark, path):
    orders = table(spark, path, "orders").select("o_orderkey", "o_orderdate")
    first = table(spark, path, "lineitem").groupBy("l_orderkey").agg(F.min("l_shipdate").alias("s"))
    span = F.lit(timedelta(days=365))
    near = F.col("s").between(F.col("o_orderdate") - span, F.col("o_orderdate") + span)
    both = orders.join(first, (F.col("o_orderkey") == F.col("l_orderkey")) & near, "full_outer")
    return both.where("o_orderkey IS NOT NULL AND l_orderkey IS NOT NULL")


PLAIN = (
    hot_items_topn,
    running_unique_visitors,
    consecutive_fail_pairs,
    create_pay_match,
    unpaid_orders_lookback,
    reconcile_matched,
)


def main() -> None:
    path = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "").split(",")
    conf = {"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g"}
    conf["spark.ui.showConsoleProgress"] = "false"
    spark = build_session("bench-plain", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    for plain in PLAIN:
        if chosen != [""] and plain.__name__ not in chosen:
            continue
        best = [
            min([timed(query, spark, path) for _ in range(3)][1:])
            for query in (plain, catalog.QUERIES[plain.__name__])
        ]
        print(f"{plain.__name__} {best[0]} {best[1]}", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
