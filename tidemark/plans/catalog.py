"""The operators as queries over the given tables.

``events`` stands in for the behaviour, login, ad and order logs; ``orders`` and
``lineitem`` for the two sides of a reconciliation.  Spans are scaled to the tables: the
rows of one user are hours apart, so seconds and minutes become hours and days.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.session import prepare
from tidemark.sources import (
    AD_CLICK,
    BEHAVIOR,
    KEY_TIME,
    LOGIN,
    MARKET,
    ORDER,
    RECEIPT,
    RecordFormat,
    accepted,
    parse_access_log,
    parse_lines,
    parse_mixed,
)

HOUR, DAY = timedelta(hours=1), timedelta(days=1)

CHANNELS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table with the number inside ``props`` as ``k`` and ``event_id`` as ``seq``."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("seq"), "ts", "user_id", "event_type", k.alias("k")
    )


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).where(F.col("event_type") == "view")


# --- counts and rankings


def hot_items_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = views(spark, sf_dir).withColumnRenamed("k", "item_id")
    return op.top_n(op.window_count(items, ["item_id"], 6 * HOUR, HOUR), 3, "item_id")


def topn_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.ranking_report(
        hot_items_topn(spark, sf_dir), "item_id", title="time: ", header="item -> count"
    )


def key_sliding_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.window_count(events(spark, sf_dir), ["event_type"], 6 * HOUR, 2 * HOUR)


def access_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event written as a line of a web access log."""
    line = F.concat_ws(
        " ",
        F.concat(F.lit("10.0.0."), F.col("user_id")),
        F.lit("- -"),
        F.date_format("ts", "dd/MM/yyyy:HH:mm:ss"),
        F.lit("+0000"),
        F.lit("GET"),
        F.concat(F.lit("/"), F.col("event_type"), F.lit("/"), F.col("k")),
    )
    return events(spark, sf_dir).select(line.alias("value"))


def hot_pages_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = accepted(parse_access_log(access_lines(spark, sf_dir)))
    pages = pages.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    return op.top_n(op.window_count(pages, ["url"], 6 * HOUR, HOUR), 5, "url")


# --- the delimited logs


def log_line(fmt: RecordFormat) -> Column:
    """An event written as a line of ``fmt``; of some the time is no time, far too large or
    missing."""
    k, kind, user = F.col("k"), F.col("event_type"), F.col("user_id")
    unit = 1_000_000 if fmt.unit == "seconds" else 1000
    time = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / unit).cast("string")
    broken = F.col("seq") % 50
    time = (
        F.when(broken == 7, "soon")
        .when(broken == 13, F.concat(time, F.lit("000000000000")))
        .when(broken == 21, "")
        .otherwise(time)
    )
    paid = F.when(k % 3 > 0, F.concat(F.lit("p"), k)).otherwise("")
    parts = {
        BEHAVIOR: [user, k, k % 7, kind, time],
        AD_CLICK: [user, k, F.concat(F.lit("province"), k % 5), F.concat(F.lit("city"), k % 9), time],
        LOGIN: [user, F.concat(F.lit("10.0.0."), k), kind, time],
        ORDER: [user, kind, paid, time],
        RECEIPT: [F.concat(F.lit("p"), k), kind, time],
        MARKET: [user, F.concat(F.lit("channel"), k % CHANNELS), time, kind],
        KEY_TIME: [kind, time],
    }
    return F.concat_ws(fmt.sep, *parts[fmt])


FORMATS = (BEHAVIOR, AD_CLICK, LOGIN, ORDER, RECEIPT, MARKET, KEY_TIME)


def mixed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line of every format, parsed in one pass."""
    lines = F.array(*[F.struct(F.lit(fmt.name).alias("format"), log_line(fmt).alias("value")) for fmt in FORMATS])
    return parse_mixed(events(spark, sf_dir).select(F.inline(lines)), FORMATS)


def parsed_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted records and rejects of every format, with the times of the accepted."""
    times = F.coalesce(*[F.col(f"{fmt.name}.ts") for fmt in FORMATS])
    good = F.when(~F.col("_rejected"), times.cast("timestamp_ntz"))
    return mixed_log(spark, sf_dir).groupBy("format").agg(
        F.count_if(~F.col("_rejected")).alias("accepted"),
        F.count_if("_rejected").alias("rejected"),
        F.min(good).alias("first_ts"),
        F.max(good).alias("last_ts"),
    )


def rejected_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_log(spark, sf_dir).where("_rejected").select("format", F.col("_line").alias("line"))


def paid_order_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order records with a payment id, as read from their lines."""
    orders = accepted(parse_lines(events(spark, sf_dir).select(log_line(ORDER).alias("value")), ORDER))
    paid = orders.where(F.col("pay_id").isNotNull())
    return paid.select("order_id", "state", "pay_id", F.col("ts").cast("timestamp_ntz").alias("ts"))


def page_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.window_count(views(spark, sf_dir), [], HOUR, out="pv")


def channel_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = (
        events(spark, sf_dir)
        .where(F.col("event_type") != "error")
        .select("ts", F.col("event_type").alias("behavior"), (F.col("k") % CHANNELS).alias("channel"))
    )
    return op.window_count(rows, ["behavior", "channel"], 6 * HOUR, HOUR)


def total_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.window_count(events(spark, sf_dir), [], 6 * HOUR, HOUR)


# --- distinct visitors


def unique_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.window_distinct(views(spark, sf_dir), "user_id", DAY)


def approx_unique_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.window_approx_distinct(views(spark, sf_dir), "user_id", DAY)


def approx_unique_visitors_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the estimate of each window is within three deviations of the exact count."""
    window = F.window("ts", "1 day")
    counts = views(spark, sf_dir).groupBy(window.alias("w")).agg(
        F.countDistinct("user_id").alias("exact"), F.approx_count_distinct("user_id", 0.05).alias("uv")
    )
    within = F.abs(F.col("uv") - F.col("exact")) <= F.greatest(F.lit(1.0), 3 * 0.05 * F.col("exact"))
    return counts.select(F.col("w.end").alias("window_end"), "exact", within.alias("in_bound"))


def sketched_daily_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily visitors from sketches of every hour, and whether they are within the bound."""
    seen = views(spark, sf_dir)
    days = op.sketched_counts(op.roll_up(op.window_sketches(seen, "user_id", HOUR), DAY), "estimate")
    exact = op.window_distinct(seen, "user_id", DAY)
    near = F.abs(F.col("estimate") - F.col("uv")) <= F.lit(0.05) * F.col("uv")
    return exact.join(days, "window_end", "left").select("window_end", "uv", F.coalesce(near, F.lit(False)).alias("within"))


def event_moments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number, mean and variance of the value of every kind of event, by an own accumulator."""
    found = op.aggregate(events(spark, sf_dir), ["event_type"], op.Moments(), ["k"])
    return found.select("event_type", "n", F.round("mean", 6).alias("mean"), F.round("variance", 3).alias("variance"))


def running_unique_visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views(spark, sf_dir).select("seq", "ts", "user_id")
    return op.running_distinct(rows, "user_id", DAY)


# --- caps


def capped_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir).select("seq", "ts", "user_id", "event_type")
    return op.click_cap(rows, ["user_id"], cap=1)


def click_cap_pass_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    passed = capped_clicks(spark, sf_dir).where(F.col("kind") == "pass")
    return op.window_count(passed, ["event_type"], 6 * HOUR, HOUR)


def click_cap_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    warned = capped_clicks(spark, sf_dir).where(F.col("kind") == "warn")
    return warned.select("user_id", "ts", F.lit("clicked more often than allowed").alias("msg"))


# --- login failures


def is_error():
    return F.col("event_type") == "error"


def fail_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.fail_burst(events(spark, sf_dir), ["user_id"], is_error(), 2 * DAY)


def consecutive_fail_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.consecutive_pairs(events(spark, sf_dir), ["user_id"], is_error(), 12 * HOUR)


def fail_fail_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.strict_sequence(events(spark, sf_dir), ["user_id"], is_error(), is_error(), DAY)


# --- orders and payments


def is_create():
    return F.col("event_type") == "signup"


def is_pay():
    return F.col("event_type") == "purchase"


def create_pay(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.followed_by(events(spark, sf_dir), ["user_id"], is_create(), is_pay(), DAY)


def create_pay_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    matched = create_pay(spark, sf_dir).where(F.col("kind") == "matched")
    return matched.select(
        "user_id", F.col("first_ts").alias("create_ts"), F.col("then_ts").alias("pay_ts")
    )


def create_pay_timeout(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = create_pay(spark, sf_dir).where(F.col("kind") == "timeout")
    return late.select("user_id", F.col("first_ts").alias("create_ts"))


def unpaid_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.missing_follow_up(
        events(spark, sf_dir), ["user_id"], is_create(), is_pay(), DAY
    ).withColumnRenamed("first_ts", "create_ts")


def unpaid_orders_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.missing_follow_up(
        events(spark, sf_dir), ["user_id"], is_create(), is_pay(), DAY, lookback=DAY
    ).withColumnRenamed("first_ts", "create_ts")


def order_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op.lifecycle_status(events(spark, sf_dir), ["user_id"], is_create(), is_pay(), DAY)


# --- reconciliation


def reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against the first shipment of each order."""
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("pay_id"), F.col("o_orderdate").alias("ts"), F.lit(0).alias("seq")
    )
    receipts = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("pay_id"))
        .agg(F.min("l_shipdate").alias("ts"))
        .withColumn("seq", F.lit(0))
    )
    # Both sides have one row per key, so no key can be heavy.
    return op.reconcile(orders, receipts, "pay_id", 365 * DAY, rows_per_task=None)


def reconcile_matched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        reconciled(spark, sf_dir)
        .where(F.col("kind") == "matched")
        .select("pay_id", F.col("left.ts").alias("order_ts"), F.col("right.ts").alias("receipt_ts"))
    )


def reconcile_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    msg = F.when(F.col("kind") == "left_only", "receiptState time out").otherwise("pay time out")
    return (
        reconciled(spark, sf_dir).where(F.col("kind") != "matched").select("pay_id", msg.alias("msg"))
    )


def reconcile_shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipments against the receipts of the same order: many rows of a key on both sides."""
    items = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
    odd = F.col("l_linenumber") % 2 == 1
    sent = items.where(odd).select(
        F.col("l_orderkey").alias("pay_id"), F.col("l_shipdate").alias("ts"), F.col("l_linenumber").alias("seq")
    )
    got = items.where(~odd).select(
        F.col("l_orderkey").alias("pay_id"), F.col("l_shipdate").alias("ts"), F.col("l_linenumber").alias("seq")
    )
    pairs = op.reconcile(sent, got, "pay_id", 20 * DAY)
    return pairs.select(
        "pay_id", "kind", F.col("left.seq").alias("sent"), F.col("right.seq").alias("received")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        hot_items_topn,
        topn_report,
        key_sliding_count,
        hot_pages_topn,
        parsed_logs,
        rejected_lines,
        paid_order_log,
        page_views,
        channel_counts,
        total_counts,
        unique_visitors,
        approx_unique_visitors,
        approx_unique_visitors_error,
        sketched_daily_visitors,
        event_moments,
        running_unique_visitors,
        click_cap_pass_counts,
        click_cap_warnings,
        fail_burst,
        consecutive_fail_pairs,
        fail_fail_pattern,
        create_pay_match,
        create_pay_timeout,
        unpaid_orders,
        unpaid_orders_lookback,
        order_lifecycle,
        reconcile_matched,
        reconcile_warnings,
        reconcile_shipments,
    )
}
