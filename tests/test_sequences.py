import random
from datetime import timedelta

import helpers as h
import pytest
from helpers import frame, random_log, rows_of
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.operators import caps, skew

SECOND = timedelta(seconds=1)
LOG = "user string, state string, ts timestamp, seq bigint"
SPLITS = [None, 5]  # keys left whole; keys above five rows cut into slices
SEEDS = [1, 2]


def fail():
    return F.col("state") == "fail"


def create():
    return F.col("state") == "create"


def pay():
    return F.col("state") == "pay"


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seed", SEEDS)
def test_pairs(spark, split, seed):
    rows = random_log(seed)
    df = frame(spark, rows, LOG)
    got = op.consecutive_pairs(df, ["user"], fail(), 4 * SECOND, rows_per_task=split)
    assert rows_of(got) == h.pairs(rows, 4)


def test_pair_boundaries(spark):
    rows = [
        ("a", "fail", 0, 0),
        ("a", "fail", 10, 1),  # exactly the limit apart: no match
        ("a", "fail", 19, 2),
        ("a", "ok", 20, 3),
        ("a", "fail", 21, 4),  # a success between
        ("a", "fail", 21, 5),  # equal time, later in the log
    ]
    got = op.strict_sequence(frame(spark, rows, LOG), ["user"], fail(), fail(), 10 * SECOND)
    assert rows_of(got) == [("a", 10, 19), ("a", 21, 21)]


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("states", [("fail", "ok"), ("fail", "fail", "fail", "fail", "ok"), ("fail",)])
@pytest.mark.parametrize("seed", SEEDS)
def test_bursts(spark, split, states, seed):
    rows = random_log(seed, states=states)
    df = frame(spark, rows, LOG)
    got = op.fail_burst(df, ["user"], fail(), 3 * SECOND, rows_per_task=split)
    assert rows_of(got) == h.bursts(rows, 3, 2)


def test_long_run_of_fails_crosses_batches(spark):
    rows = [("a", "fail", ts // 2, ts) for ts in range(400)] + [("b", "fail", 1, 900)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = rows_of(op.fail_burst(frame(spark, rows, LOG), ["user"], fail(), 5 * SECOND, 3))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == h.bursts(rows, 5, 3)


def test_burst_boundaries(spark):
    rows = [
        ("a", "fail", 0, 0),
        ("a", "fail", 2, 1),  # at the horizon: still inside
        ("a", "fail", 3, 2),  # next burst
        ("a", "ok", 4, 3),
        ("a", "fail", 4, 4),
        ("a", "fail", 5, 5),
    ]
    got = op.fail_burst(frame(spark, rows, LOG), ["user"], fail(), 2 * SECOND)
    assert rows_of(got) == [("a", 0, 2, 2), ("a", 4, 5, 2)]


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("seed", SEEDS)
def test_followed_by(spark, split, seed):
    rows = random_log(seed, states=("create", "create", "pay", "other"))
    df = frame(spark, rows, LOG)
    got = op.followed_by(df, ["user"], create(), pay(), 3 * SECOND, rows_per_task=split)
    assert rows_of(got) == h.follows(rows, 3)


def test_followed_by_cases(spark):
    rows = [
        ("two creates", "create", 0, 0),
        ("two creates", "create", 1, 1),
        ("two creates", "pay", 2, 2),
        ("two pays", "create", 0, 3),
        ("two pays", "pay", 1, 4),
        ("two pays", "pay", 2, 5),
        ("early pay", "pay", 0, 6),
        ("early pay", "create", 1, 7),
        ("at limit", "create", 0, 8),
        ("at limit", "pay", 10, 9),
        ("same time", "create", 5, 10),
        ("same time", "pay", 5, 11),
    ]
    got = op.followed_by(frame(spark, rows, LOG), ["user"], create(), pay(), 10 * SECOND)
    assert rows_of(got) == h.follows(rows, 10)
    assert rows_of(got.where("kind = 'timeout'"), "user") == [("at limit",), ("early pay",)]


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("lookback", [None, 2])
@pytest.mark.parametrize("seed", SEEDS)
def test_missing_follow_up(spark, split, lookback, seed):
    rows = random_log(seed, states=("create", "create", "pay", "other"))
    df = frame(spark, rows, LOG)
    got = op.missing_follow_up(
        df,
        ["user"],
        create(),
        pay(),
        2 * SECOND,
        lookback=lookback and lookback * SECOND,
        rows_per_task=split,
    )
    assert rows_of(got) == h.unpaid(rows, 2, lookback)


@pytest.mark.parametrize("seed", SEEDS)
def test_lifecycle(spark, seed):
    rows = random_log(seed, n=40, states=("create", "pay", "other"), users=tuple("abcdefghijk"))
    got = op.lifecycle_status(frame(spark, rows, LOG), ["user"], create(), pay(), 5 * SECOND)
    assert rows_of(got, "user", "status") == h.lifecycle(rows, 5)


@pytest.mark.parametrize("inclusive", [False, True])
@pytest.mark.parametrize("threshold", ["1000", "3"])
def test_cap(spark, inclusive, threshold):
    rows = random_log(7, span=200)
    spark.conf.set(caps.LIMIT_CONF, threshold)
    try:
        got = rows_of(
            op.click_cap(
                frame(spark, rows, LOG), ["user"], 4, inclusive=inclusive, period=50 * SECOND
            ),
            "user",
            "seq",
            "kind",
        )
    finally:
        spark.conf.unset(caps.LIMIT_CONF)
    assert got == h.capped(rows, 4 if inclusive else 5, 50)
    assert all(n <= 1 for n in warnings_per_period(rows, got).values())


def warnings_per_period(rows, got):
    period = {seq: (user, (h.BASE + ts) // 50) for user, _, ts, seq in rows}
    found = {}
    for _, seq, kind in got:
        if kind == "warn":
            found[period[seq]] = found.get(period[seq], 0) + 1
    return found


@pytest.mark.parametrize("clicks,kinds", [(100, "pass"), (101, "pass"), (102, "warn")])
def test_cap_boundary(spark, clicks, kinds):
    rows = [("a", "x", i, i) for i in range(clicks)]
    got = rows_of(op.click_cap(frame(spark, rows, LOG), ["user"], 100), "kind")
    assert len(got) == clicks and got[-1] == (kinds,)


def test_cap_is_cut_before_the_shuffle(spark):
    df = frame(spark, [("a", "x", 1, 1)], LOG)
    plan = op.click_cap(df, ["user"], 100)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def sides(seed, keys=("hot", "b", "c", None), n=70, span=60):
    left = [(k, ts, seq) for k, _, ts, seq in random_log(seed, n, span, users=keys)]
    right = [(k, ts, seq) for k, _, ts, seq in random_log(seed + 100, n, span, users=keys)]
    return left, right


SIDE = "key string, ts timestamp, seq bigint"


@pytest.mark.parametrize("split", SPLITS)
@pytest.mark.parametrize("tolerance", [0, 1, 5])
@pytest.mark.parametrize("seed", SEEDS)
def test_reconcile(spark, split, tolerance, seed):
    left, right = sides(seed)
    got = op.reconcile(
        frame(spark, left, SIDE),
        frame(spark, right, SIDE),
        "key",
        tolerance * SECOND,
        rows_per_task=split,
    )
    found = rows_of(got, "key", "kind", "left.seq", "right.seq")
    assert found == h.reconciled(left, right, tolerance)
    assert sorted(r[2] for r in found if r[2] is not None) == sorted(r[2] for r in left)
    assert sorted(r[3] for r in found if r[3] is not None) == sorted(r[2] for r in right)


def test_reconcile_boundary(spark):
    left = [("at", 0, 0), ("beyond", 0, 1)]
    right = [("at", 5, 0), ("beyond", 5.001, 1)]
    got = op.reconcile(
        frame(spark, left, SIDE), frame(spark, right, SIDE), "key", 5 * SECOND
    )
    assert rows_of(got, "key", "kind") == [
        ("at", "matched"),
        ("beyond", "left_only"),
        ("beyond", "right_only"),
    ]


def test_empty_input(spark):
    df = frame(spark, [], LOG)
    side = frame(spark, [], SIDE)
    empty = [
        op.consecutive_pairs(df, ["user"], fail(), SECOND),
        op.fail_burst(df, ["user"], fail(), SECOND),
        op.followed_by(df, ["user"], create(), pay(), SECOND),
        op.missing_follow_up(df, ["user"], create(), pay(), SECOND, SECOND),
        op.lifecycle_status(df, ["user"], create(), pay(), SECOND),
        op.click_cap(df, ["user"], 1),
        op.reconcile(side, side, "key", SECOND),
        op.window_count(df, ["user"], 2 * SECOND, SECOND),
        op.running_distinct(df, "user", SECOND),
    ]
    assert [frame.count() for frame in empty] == [0] * len(empty)


@pytest.mark.parametrize("slices", [None, 2])
@pytest.mark.parametrize("at,cancelled", [(0.5, True), (1, True), (1.5, True), (2, True), (2.000001, False), (3, False)])
def test_a_success_up_to_the_horizon_discards_a_burst(spark, at, cancelled, slices):
    rows = [("a", "fail", 0, 0), ("a", "fail", 1, 1), ("a", "ok", at, 2), ("a", "fail", 10, 3), ("a", "fail", 11, 4)]
    got = op.fail_burst(frame(spark, rows, LOG), ["user"], F.col("state") == "fail", 2 * SECOND, rows_per_task=slices)
    want = [("a", 10, 11, 2)] if cancelled else [("a", 0, 1, 2), ("a", 10, 11, 2)]
    assert rows_of(got) == want


@pytest.mark.parametrize("horizon", [0, 1, 7, 1000])
def test_runs_through_many_slices(spark, horizon):
    """Fails of one key, mostly without a gap or a success, in slices of a few rows."""
    rng = random.Random(horizon)
    times = sorted(rng.randrange(400) for _ in range(500))
    rows = [("hot", "ok" if rng.random() < 0.01 else "fail", ts, seq) for seq, ts in enumerate(times)]
    rows += [(None, "fail", ts, 1000 + ts) for ts in range(0, 300, 2)] + [("b", "fail", 5, 2000), ("b", "fail", 5, 2001)]
    got = op.fail_burst(frame(spark, rows, LOG), ["user"], fail(), horizon * SECOND, rows_per_task=20)
    assert rows_of(got) == h.bursts(rows, horizon, 2)


def test_an_endless_run_is_spread_over_tasks(spark):
    """A run of a million fails of one key, far above the rows a task may have."""
    n, horizon, limit = 1_000_000, 2_000_000, 100_000
    step = F.xxhash64("id") % 5_000
    rows = spark.range(n).select(
        F.lit("k").alias("user"),
        F.lit("fail").alias("state"),
        F.timestamp_micros(F.col("id") * 10_000 + F.abs(step)).alias("ts"),
        F.col("id").alias("seq"),
    )
    sliced, split = skew.slice_keys(rows.withColumn("_us", F.unix_micros("ts")), ["user"], limit)
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert split and len(sizes) >= n // limit and max(sizes) <= 2 * limit
    got = op.fail_burst(rows, ["user"], fail(), timedelta(microseconds=horizon), rows_per_task=limit)
    us = rows.select(F.unix_micros("ts").alias("us")).toPandas()["us"].sort_values().to_numpy()
    want, at = [], 0
    while at < n:
        end = int(us.searchsorted(us[at] + horizon, "right"))
        want.append((int(us[at]), int(us[end - 1]), end - at))
        at = end
    found = got.select(F.unix_micros("first_ts"), F.unix_micros("last_ts"), "cnt").collect()
    assert sorted(map(tuple, found)) == [w for w in want if w[2] > 1]


def test_slices_of_a_busy_hour(spark):
    """Nine rows in ten lie in one hour of a year; slices still hold about as many rows each."""
    n, limit = 200_000, 20_000
    busy = F.when(F.col("id") % 10 > 0, F.col("id") * 16_000).otherwise(F.col("id") * 150_000_000)
    rows = spark.range(n).select((F.col("id") % 2).alias("k"), busy.alias("_us")).where("k = 0 OR _us < 1000000000")
    sliced, split = skew.slice_keys(rows, ["k"], limit)
    counts = sliced.groupBy("k", "_slice").agg(F.count("*").alias("n"), F.min("_us").alias("a"), F.max("_us").alias("b"))
    found = counts.orderBy("k", "a").collect()
    assert split and max(r.n for r in found) <= 2 * limit
    for r, later in zip(found, found[1:]):
        assert r.k != later.k or (r.b < later.a and r._slice < later._slice)


def test_wide_rows_are_not_broadcast(spark):
    """Rows of 10 kB in forced slices: what crosses a slice is fetched by a shuffled join."""
    rng = random.Random(6)
    left = [("k", rng.randrange(300), seq) for seq in range(250)]
    right = [("k", rng.randrange(300), seq) for seq in range(250)]
    pad = F.concat(F.col("seq").cast("string"), F.repeat(F.lit("x"), 10_000)).alias("pad")
    sides = [frame(spark, rows, SIDE).select("*", pad) for rows in (left, right)]
    got = op.reconcile(*sides, "key", 2 * SECOND, rows_per_task=20)
    found = got.select("key", "kind", "left.seq", "right.seq", F.length("left.pad"), F.length("right.pad")).collect()
    want = h.reconciled(left, right, 2)
    assert h.ordered(tuple(r)[:4] for r in found) == want
    assert all((r[2] is None) == (r[4] is None) and (r[3] is None) == (r[5] is None) for r in found)
    plan = got._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")
    for sent in plan[1:]:
        # The output of what is broadcast: the projection right below it.
        assert "left#" not in sent.split("\n")[1] and "right#" not in sent.split("\n")[1]
