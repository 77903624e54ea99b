"""The ready-made analyses on small hand-written logs, each at its usual parameters."""

import pytest
from helpers import frame, rows_of
from streams import as_stream, drained

from tidemark.plans import jobs

BEHAVIOR = "user_id bigint, item_id bigint, category_id int, behavior string, ts timestamp, seq bigint"
LOGIN = "user_id bigint, ip string, state string, ts timestamp, seq bigint"
ORDER = "order_id bigint, state string, pay_id string, ts timestamp, seq bigint"
RECEIPT = "pay_id string, pay_type string, ts timestamp, seq bigint"
CLICK = "user_id bigint, ad_id bigint, province string, city string, ts timestamp, seq bigint"
MARKET = "user_id bigint, channel string, ts timestamp, behavior string"

# The base of the tests is 80 s into its five-minute pane.
VIEWS = [
    (1, 10, 7, "pv", 0, 0),
    (2, 10, 7, "pv", 1, 1),
    (1, 11, 7, "pv", 2, 2),
    (3, 11, 7, "buy", 3, 3),
    (1, 10, 7, "pv", 3600, 4),
]


def test_traffic(spark):
    df = frame(spark, VIEWS, BEHAVIOR)
    hot = rows_of(jobs.hot_items(df, 1), "window_end", "item_id", "cnt")
    assert hot[0] == (100, 10, 2) and hot[-1] == (100 + 3600 + 11 * 300, 10, 1)
    assert len(hot) == 24
    assert rows_of(jobs.page_views(df), "window_end", "cnt") == [(40, 3), (3640, 1)]
    assert rows_of(jobs.unique_visitors(df)) == [(40, 2), (3640, 1)]
    assert rows_of(jobs.running_visitors(df), "seq", "uv", "is_new") == [
        (0, 1, True),
        (1, 2, True),
        (2, 2, False),
        (4, 1, True),
    ]
    assert [uv for _, uv in rows_of(jobs.approximate_visitors(df))] == [2, 1]


def test_access_log(spark):
    rows = [("ip", 0, "/a"), ("ip", 1, "/b"), ("ip", 2, "/a")]
    top = jobs.hot_pages(frame(spark, rows, "ip string, ts timestamp, url string"), 1)
    assert {(r[1], r[2]) for r in rows_of(top, "window_end", "url", "cnt")} == {("/a", 2)}


def test_key_counts(spark):
    got = jobs.key_counts(frame(spark, [("a", i) for i in range(12)], "k string, ts timestamp"))
    assert [n for _, _, n in rows_of(got, "k", "window_end", "cnt")] == [2, 4, 6, 6, 6, 6, 4, 2]


def test_market(spark):
    rows = [
        (1, "AppStore", 0, "Click"),
        (2, "AppStore", 5, "Click"),
        (1, "Weibo", 5, "Uninstall"),
    ]
    df = frame(spark, rows, MARKET)
    channels = rows_of(jobs.channel_counts(df), "behavior", "channel", "window_end", "cnt")
    assert {r[:2] for r in channels} == {("Click", "AppStore")} and len(channels) == 360
    totals = rows_of(jobs.market_total(df))
    assert len(totals) == 360 and {n for _, n in totals} == {3}


def test_ad_clicks(spark):
    rows = [(1, 5, "beijing", "beijing", i, i) for i in range(110)]
    rows += [(2, 5, "hebei", "x", 0, 200), (1, 5, "beijing", "beijing", 86400, 201)]
    capped = jobs.capped_ad_clicks(frame(spark, rows, CLICK))
    kinds = {r.kind: r["count"] for r in capped.groupBy("kind").count().collect()}
    assert kinds == {"pass": 101 + 2, "warn": 1}
    assert rows_of(jobs.click_warnings(capped), "user_id", "ad_id") == [(1, 5)]
    peak = {p: n for p, n in jobs.province_clicks(capped).groupBy("province").max("cnt").collect()}
    assert peak == {"beijing": 101, "hebei": 1}


LOGINS = [
    (1, "ip", "fail", 0, 0),
    (1, "ip", "fail", 1, 1),
    (1, "ip", "fail", 2, 2),
    (1, "ip", "success", 3, 3),
    (2, "ip", "fail", 0, 4),
    (2, "ip", "fail", 599, 5),
    (3, "ip", "fail", 0, 6),
    (3, "ip", "success", 1, 7),
    (3, "ip", "fail", 1, 8),
]


def test_logins(spark):
    df = frame(spark, LOGINS, LOGIN)
    assert rows_of(jobs.login_bursts(df), "user_id", "first_ts", "last_ts", "cnt") == [(1, 0, 2, 3)]
    pairs = rows_of(jobs.login_fail_pairs(df), "user_id", "first_ts", "last_ts", "cnt")
    assert pairs == [(1, 0, 1, 2), (1, 1, 2, 2)]
    pattern = rows_of(jobs.login_fail_pattern(df), "user_id", "first_ts", "last_ts", "cnt")
    assert pattern == [*pairs, (2, 0, 599, 2)]


ORDERS = [
    (1, "create", None, 0, 0),
    (1, "pay", "p1", 100, 1),
    (2, "create", None, 0, 2),
    (2, "pay", "p2", 180, 3),  # at the three-minute deadline: too late
    (3, "create", None, 0, 4),
    (4, "pay", "p4", 10, 5),
    (5, "pay", "p5", 5, 6),
    (5, "create", None, 9, 7),  # paid first
]
RECEIPTS = [("p1", "wechat", 105, 0), ("p2", "alipay", 186, 1), ("p9", "alipay", 0, 2)]


def test_orders(spark):
    df = frame(spark, ORDERS, ORDER)
    assert rows_of(jobs.paid_orders(df)) == [
        (1, 0, 100, "matched"),
        (2, 0, 180, "matched"),
        (3, 0, None, "timeout"),
        (5, 9, None, "timeout"),
    ]
    assert rows_of(jobs.unpaid_orders(df), "order_id") == [(2,), (3,)]
    assert rows_of(jobs.order_status(df), "order_id", "status") == [
        (1, "paid"),
        (2, "timeout"),
        (3, "timeout"),
        (4, "no_create"),
        (5, "paid"),
    ]


def test_payments(spark):
    got = jobs.reconciled_payments(frame(spark, ORDERS, ORDER), frame(spark, RECEIPTS, RECEIPT))
    assert rows_of(got, "pay_id", "kind") == [
        ("p1", "matched"),
        ("p2", "left_only"),
        ("p2", "right_only"),
        ("p4", "left_only"),
        ("p5", "left_only"),
        ("p9", "right_only"),
    ]
    assert rows_of(jobs.payment_warnings(got)) == [
        ("p2", "pay time out"),
        ("p2", "receiptState time out"),
        ("p4", "receiptState time out"),
        ("p5", "receiptState time out"),
        ("p9", "pay time out"),
    ]


@pytest.mark.parametrize("job", [jobs.paid_orders, jobs.unpaid_orders, jobs.order_status])
def test_order_jobs_on_a_stream(spark, job):
    key = [c for c in job(frame(spark, ORDERS, ORDER)).columns if c in ("order_id", "kind", "status")]
    stream = as_stream(
        spark, ORDERS, ORDER, lambda ts: (-1, "create", None, ts, 9), None, order=lambda r: r[3]
    )
    got = [r for r in drained(spark, job(stream), *key) if r[0] != -1]
    assert got == rows_of(job(frame(spark, ORDERS, ORDER)), *key)
