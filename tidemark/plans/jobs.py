"""Ready-made analyses with their usual parameters.

Each job takes parsed events (see ``sources``), batch or streaming, and gives a result
table.  A stream gets its event time and watermark here.  Batch events need a ``seq``
column where records of equal time must keep their order (``read_events(seq="seq")``).
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.operators import with_event_time

SECOND, MINUTE, HOUR = timedelta(seconds=1), timedelta(minutes=1), timedelta(hours=1)
DAY = timedelta(days=1)


def page_view_events(behavior: DataFrame) -> DataFrame:
    return with_event_time(behavior, "ts").where(F.col("behavior") == "pv")


def is_state(state: str) -> Column:
    return F.col("state") == state


# --- traffic


def item_counts(behavior: DataFrame) -> DataFrame:
    """Views per item over the last hour, every five minutes."""
    return op.window_count(page_view_events(behavior), ["item_id"], HOUR, 5 * MINUTE)


def hot_items(behavior: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` most viewed items per window (batch; a stream ranks ``item_counts`` in its sink)."""
    return op.top_n(item_counts(behavior), n, "item_id")


def url_counts(access_log: DataFrame, lateness: timedelta = MINUTE) -> DataFrame:
    """Requests per url over the last hour, every five minutes.

    On a stream, records up to ``lateness`` late still count: append mode gives each
    window once, after that time; update mode gives it early and refines it.
    """
    return op.window_count(with_event_time(access_log, "ts", lateness), ["url"], HOUR, 5 * MINUTE)


def hot_pages(access_log: DataFrame, n: int = 5) -> DataFrame:
    return op.top_n(url_counts(access_log), n, "url")


def key_counts(keyed: DataFrame) -> DataFrame:
    """Records per key over the last six seconds, every two seconds."""
    return op.window_count(with_event_time(keyed, "ts"), ["k"], 6 * SECOND, 2 * SECOND)


def page_views(behavior: DataFrame) -> DataFrame:
    return op.window_count(page_view_events(behavior), [], MINUTE)


def unique_visitors(behavior: DataFrame) -> DataFrame:
    return op.window_distinct(page_view_events(behavior), "user_id", MINUTE)


def approximate_visitors(behavior: DataFrame, rsd: float = 0.02) -> DataFrame:
    return op.window_approx_distinct(page_view_events(behavior), "user_id", HOUR, rsd)


def running_visitors(behavior: DataFrame) -> DataFrame:
    """Visitors of the hour so far: at every view, or on a stream at every update (update mode)."""
    views = page_view_events(behavior)
    if views.isStreaming:
        return op.running_distinct_updates(views, "user_id", HOUR)
    return op.running_distinct(views, "user_id", HOUR)


# --- marketing


def channel_counts(market: DataFrame, excluded: str = "Uninstall", panes: bool = True) -> DataFrame:
    """Events per behaviour and channel over the last hour, every ten seconds.

    Here and below ``panes=False`` lets a stream run in update mode, at a higher cost."""
    kept = with_event_time(market, "ts").where(F.col("behavior") != excluded)
    return op.window_count(kept, ["behavior", "channel"], HOUR, 10 * SECOND, panes=panes)


def market_total(market: DataFrame, panes: bool = True) -> DataFrame:
    return op.window_count(with_event_time(market, "ts"), [], HOUR, 10 * SECOND, panes=panes)


def capped_ad_clicks(clicks: DataFrame, cap: int = 100) -> DataFrame:
    """Clicks with ``kind``: those that pass the daily cap per user and ad, and the warnings."""
    return op.click_cap(with_event_time(clicks, "ts"), ["user_id", "ad_id"], cap)


def province_clicks(capped: DataFrame, panes: bool = True) -> DataFrame:
    """Passed clicks per province over the last hour, every five seconds."""
    passed = capped.where(F.col("kind") == "pass")
    return op.window_count(passed, ["province"], HOUR, 5 * SECOND, panes=panes)


def click_warnings(capped: DataFrame) -> DataFrame:
    warned = capped.where(F.col("kind") == "warn")
    return warned.select("user_id", "ad_id", F.lit("clicked more often than allowed").alias("msg"))


# --- logins


def login_bursts(logins: DataFrame, min_count: int = 2) -> DataFrame:
    """Users with several failures within two seconds and no success in between."""
    logs = with_event_time(logins, "ts", SECOND)
    found = op.fail_burst(logs, ["user_id"], is_state("fail"), 2 * SECOND, min_count)
    return found.withColumn("msg", F.lit("login fail warning"))


def login_fail_pairs(logins: DataFrame) -> DataFrame:
    """Two failures in a row less than two seconds apart."""
    logs = with_event_time(logins, "ts", SECOND)
    pairs = op.consecutive_pairs(logs, ["user_id"], is_state("fail"), 2 * SECOND)
    return pairs.select("*", F.lit(2).cast("bigint").alias("cnt"), F.lit("login fail abnormal").alias("msg"))


def login_fail_pattern(logins: DataFrame) -> DataFrame:
    """Two failures in a row within ten minutes."""
    logs = with_event_time(logins, "ts")
    fail = is_state("fail")
    pairs = op.strict_sequence(logs, ["user_id"], fail, fail, 10 * MINUTE)
    return pairs.select("*", F.lit(2).cast("bigint").alias("cnt"), F.lit("warning").alias("msg"))


# --- orders


def paid_orders(orders: DataFrame) -> DataFrame:
    """Every created order as ``matched`` with its payment or ``timeout`` after ten minutes."""
    logs = with_event_time(orders, "ts", MINUTE)
    return op.followed_by(logs, ["order_id"], is_state("create"), is_state("pay"), 10 * MINUTE)


def unpaid_orders(orders: DataFrame, lookback: timedelta | None = DAY) -> DataFrame:
    """Orders without a payment from ``lookback`` before to three minutes after creation.

    ``None`` looks back without limit, on a batch only."""
    logs = with_event_time(orders, "ts", MINUTE)
    missing = op.missing_follow_up(
        logs, ["order_id"], is_state("create"), is_state("pay"), 3 * MINUTE, lookback
    )
    return missing.select(
        "order_id", F.col("first_ts").alias("create_ts"), F.lit("order time out").alias("msg")
    )


def order_status(orders: DataFrame, wait: timedelta = DAY) -> DataFrame:
    """One status per order: paid within three minutes, timed out, or paid but never created."""
    logs = with_event_time(orders, "ts", MINUTE)
    return op.lifecycle_status(
        logs, ["order_id"], is_state("create"), is_state("pay"), 3 * MINUTE, wait=wait
    )


def reconciled_payments(orders: DataFrame, receipts: DataFrame) -> DataFrame:
    """Paid orders against receipts of the same payment, five seconds apart at most."""
    paid = orders.where(F.col("pay_id").isNotNull() & (F.col("pay_id") != ""))
    return op.reconcile(
        with_event_time(paid, "ts"), with_event_time(receipts, "ts"), "pay_id", 5 * SECOND
    )


def payment_warnings(reconciled: DataFrame) -> DataFrame:
    msg = F.when(F.col("kind") == "left_only", "receiptState time out").otherwise("pay time out")
    return reconciled.where(F.col("kind") != "matched").select("pay_id", msg.alias("msg"))
