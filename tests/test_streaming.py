import tempfile
from datetime import timedelta

import helpers as h
import pytest
from helpers import frame, random_log, rows_of
from pyspark.sql import functions as F
from streams import FAR, as_stream, drain, drained

from tidemark import operators as op

SECOND = timedelta(seconds=1)
LOG = "user string, state string, ts timestamp, seq bigint"
DELAY = 300 * SECOND  # no row of the random logs is late

# Unordered rows that all wait for the sentinel, and rows in time order, with equal times across
# files, that a watermark close behind them decides one by one.
UNORDERED = None
MOVING = [UNORDERED, 0, 5]


def sentinel(state):
    return lambda ts: ("sentinel", state, ts, 10**9)


def by_time(row):
    return row[2], row[3]


def stream(spark, rows, state="end", delay=UNORDERED, **options):
    """The log as a stream; a ``delay`` in seconds takes it in time order."""
    if delay is UNORDERED:
        return as_stream(spark, rows, LOG, sentinel(state), DELAY, **options)
    return as_stream(spark, rows, LOG, sentinel(state), delay * SECOND, **{"parts": 6, "order": by_time} | options)


def fail():
    return F.col("state") == "fail"


def create():
    return F.col("state") == "create"


def pay():
    return F.col("state") == "pay"


def real(rows):
    """Rows before the sentinel."""
    return [r for r in rows if r[0] != "sentinel"]


@pytest.mark.parametrize("delay", [UNORDERED, 1])
def test_pairs(spark, delay):
    rows = random_log(1)
    got = op.consecutive_pairs(stream(spark, rows, delay=delay), ["user"], fail(), 4 * SECOND)
    assert drained(spark, got) == h.pairs(rows, 4)


@pytest.mark.parametrize("delay", [UNORDERED, 0, 1, 5])
def test_bursts(spark, delay):
    rows = random_log(2, states=("fail", "fail", "ok"))
    got = op.fail_burst(stream(spark, rows, delay=delay), ["user"], fail(), 3 * SECOND)
    assert drained(spark, got) == h.bursts(rows, 3, 2)


@pytest.mark.parametrize("delay", MOVING)
def test_followed_by(spark, delay):
    rows = random_log(3, states=("create", "create", "pay", "other"))
    got = op.followed_by(stream(spark, rows, "create", delay), ["user"], create(), pay(), 3 * SECOND)
    assert real(drained(spark, got)) == h.follows(rows, 3)


@pytest.mark.parametrize("delay", [UNORDERED, 1])
def test_missing_follow_up(spark, delay):
    rows = random_log(4, states=("create", "create", "pay", "other"))
    df = stream(spark, rows, "create", delay)
    got = op.missing_follow_up(df, ["user"], create(), pay(), 2 * SECOND, lookback=2 * SECOND)
    assert real(drained(spark, got)) == h.unpaid(rows, 2, 2)


@pytest.mark.parametrize("delay", [UNORDERED, 0, 1])
def test_lifecycle(spark, delay):
    rows = random_log(5, n=40, states=("create", "pay", "other"), users=tuple("abcdefghijk"))
    df = stream(spark, rows, "create", delay)
    got = op.lifecycle_status(df, ["user"], create(), pay(), 5 * SECOND, wait=20 * SECOND)
    found = real(drained(spark, got, "user", "create_ts", "pay_ts", "status"))
    assert [(r[0], r[3]) for r in found] == h.lifecycle(rows, 5, 20)
    batch = op.lifecycle_status(frame(spark, rows, LOG), ["user"], create(), pay(), 5 * SECOND, wait=20 * SECOND)
    assert found == rows_of(batch, "user", "create_ts", "pay_ts", "status")


def test_a_key_has_one_status_whenever_its_rows_come(spark):
    rows = [("a", "pay", 0, 0), ("b", "x", 30, 1), ("a", "create", 50, 2), ("c", "create", 60, 3), ("c", "x", 99, 4)]
    df = stream(spark, rows, "create", 0, parts=5)
    got = op.lifecycle_status(df, ["user"], create(), pay(), 5 * SECOND, wait=10 * SECOND)
    assert real(drained(spark, got, "user", "status")) == [("a", "no_create"), ("c", "timeout")]


def test_streams_that_could_not_forget_are_refused(spark):
    df = stream(spark, [])
    with pytest.raises(ValueError):
        op.missing_follow_up(df, ["user"], create(), pay(), SECOND)
    with pytest.raises(ValueError):
        op.lifecycle_status(df, ["user"], create(), pay(), SECOND)
    for rows in (df, frame(spark, [], LOG)):
        with pytest.raises(ValueError):
            op.lifecycle_status(rows, ["user"], create(), pay(), 5 * SECOND, wait=SECOND)


def test_rows_of_both_kinds(spark):
    """A fail answers the fail before it and waits for the next one."""
    rows = [("a", "fail", 0, 0), ("a", "fail", 3, 1), ("a", "fail", 30, 2)]
    want = [("a", 0, 3, "matched"), ("a", 3, None, "timeout"), ("a", 30, None, "timeout")]
    for df in (frame(spark, rows, LOG), stream(spark, rows, "fail", 1)):
        got = op.followed_by(df, ["user"], fail(), fail(), 5 * SECOND)
        assert real(rows_of(got) if not df.isStreaming else drained(spark, got)) == want


@pytest.mark.parametrize("delay", MOVING)
def test_cap_then_sliding_counts(spark, delay):
    rows = random_log(6, span=200)
    capped = op.click_cap(stream(spark, rows, delay=delay), ["user"], 4, period=50 * SECOND)
    assert real(drained(spark, capped, "user", "seq", "kind")) == h.capped(rows, 5, 50)

    passed = op.click_cap(stream(spark, rows, delay=delay), ["user"], 4, period=50 * SECOND)
    counts = op.window_count(passed.where("kind = 'pass'"), ["state"], 20 * SECOND, 10 * SECOND)
    kept = {seq for _, seq, kind in h.capped(rows, 5, 50) if kind == "pass"}
    want = h.sliding_counts([(s, ts) for _, s, ts, seq in rows if seq in kept], 20, 10)
    got = {(k, end): n for k, end, n in drained(spark, counts, "state", "window_end", "cnt")}
    assert {k: n for k, n in got.items() if k[0] != "end"} == want


SIDE = "key string, ts timestamp, seq bigint"


@pytest.mark.parametrize("delay", MOVING)
def test_reconcile(spark, delay):
    left = [(k, ts, seq) for k, _, ts, seq in random_log(7, 50)]
    right = [(k, ts, seq) for k, _, ts, seq in random_log(107, 50)]

    def side(rows):
        options = {} if delay is UNORDERED else {"parts": 6, "order": lambda r: r[1:]}
        wait = DELAY if delay is UNORDERED else delay * SECOND
        return as_stream(spark, rows, SIDE, lambda ts: ("sentinel", ts, 10**9), wait, **options)

    got = op.reconcile(side(left), side(right), "key", 2 * SECOND)
    found = drained(spark, got, "key", "kind", "left.seq", "right.seq")
    assert real(found) == h.reconciled(left, right, 2)


def test_times_without_zone_keep_their_microseconds(spark):
    rows = [("a", "x", 0.123456, 0), ("a", "x", 9.5, 1)]
    df = stream(spark, rows, delay=0).withColumn("local", F.col("ts").cast("timestamp_ntz"))
    got = drained(spark, op.click_cap(df, ["user"], 4), "user", "local")
    assert real(got) == [("a", 0.123456), ("a", 9.5)]


def test_restart_in_the_middle(spark, tmp_path):
    """A query that stops after some files goes on where it was."""
    rows = random_log(11, span=200)
    ordered = sorted(rows, key=by_time)
    chunks = [ordered[i : i + 30] for i in range(0, len(ordered), 30)] + [[sentinel("end")(10**7)], [sentinel("end")(10**7 + 1)]]
    source = (
        spark.readStream.schema(frame(spark, [], LOG).schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in" / "*"))
    )
    (tmp_path / "in").mkdir()
    capped = op.click_cap(op.with_event_time(source, "ts"), ["user"], 4, period=50 * SECOND)
    for n, chunk in enumerate(chunks):
        frame(spark, chunk, LOG).coalesce(1).write.parquet(str(tmp_path / "in" / f"{n:03d}"))
        query = (
            capped.writeStream.format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
        )
        query.awaitTermination(300)
        assert query.exception() is None
    found = rows_of(spark.read.parquet(str(tmp_path / "out")), "user", "seq", "kind")
    assert real(found) == h.capped(rows, 5, 50)


@pytest.mark.parametrize("panes", [False, True])
@pytest.mark.parametrize("size,slide", [(10, 10), (10, 5), (60, 2)])
def test_window_counts(spark, size, slide, panes):
    rows = random_log(8)
    got = op.window_count(stream(spark, rows), ["state"], size * SECOND, slide * SECOND, panes=panes)
    found = {(k, end): n for k, end, n in drained(spark, got, "state", "window_end", "cnt")}
    want = h.sliding_counts([(s, ts) for _, s, ts, _ in rows], size, slide)
    assert {k: n for k, n in found.items() if k[0] != "end"} == want


def test_distinct(spark):
    rows = random_log(9)
    want = rows_of(op.window_distinct(frame(spark, rows, LOG), "user", 20 * SECOND))
    got = drained(spark, op.window_distinct(stream(spark, rows), "user", 20 * SECOND))
    assert [r for r in got if r[0] < 10_000] == want
    near = drained(spark, op.window_approx_distinct(stream(spark, rows), "user", 20 * SECOND))
    assert [r for r in near if r[0] < 10_000] == want


def test_running_distinct_refines_towards_the_final_count(spark):
    rows = random_log(10)
    updates = drain(
        spark, op.running_distinct_updates(stream(spark, rows), "user", 20 * SECOND), "update"
    )
    want = rows_of(op.window_distinct(frame(spark, rows, LOG), "user", 20 * SECOND))
    last = updates.groupBy("window_end").agg(F.max("uv").alias("uv"))
    assert [r for r in rows_of(last) if r[0] < 10_000] == want


def test_late_rows_are_dropped_and_rows_within_the_delay_are_not(spark):
    rows = [
        ("a", "x", 0, 0),
        ("a", "x", 30, 1),
        ("a", "x", 29, 2),  # out of order, within the delay
        ("a", "x", 60, 3),
        ("a", "x", 1, 4),  # its window closed long ago
    ]
    df = stream(spark, rows, delay=5, parts=5, order=None)
    got = drained(spark, op.window_count(df, ["state"], 10 * SECOND), "state", "window_end", "cnt")
    counts = {end: n for k, end, n in got if k == "x"}
    assert sum(counts.values()) == 4


def test_late_rows_update_the_counts_of_many_windows(spark):
    """Update mode at any number of overlapping windows: rows within the delay count, and a later
    row still counts in the windows that were open when the batch before it began."""
    rows = [("a", "x", 0, 0), ("a", "x", 30, 1), ("a", "x", 28, 2), ("a", "x", 60, 3), ("a", "x", 1, 4)]
    df = stream(spark, rows, delay=5, parts=5, order=None)
    updates = drain(spark, op.window_count(df, ["state"], 26 * SECOND, 2 * SECOND), "update")
    last = updates.where("state = 'x'").groupBy("window_end").agg(F.max("cnt").alias("cnt"))
    on_time = h.sliding_counts([("x", ts) for ts in (0, 30, 28, 60)], 26, 2)
    every = h.sliding_counts([("x", ts) for ts in (0, 30, 28, 60, 1)], 26, 2)
    want = {end: every[k, end] if end > 25 else n for (k, end), n in on_time.items()}
    assert dict(rows_of(last)) == want


def test_sliding_updates_at_a_ratio_of_720(spark):
    rows = random_log(8, n=80, span=5000)
    df = stream(spark, rows, delay=5)
    got = op.window_count_updates(df, ["user"], 3600 * SECOND, 5 * SECOND)
    last = drain(spark, got, "update").groupBy("user", "window_end").agg(F.max("cnt").alias("cnt"))
    batch = op.window_count(frame(spark, rows, LOG), ["user"], 3600 * SECOND, 5 * SECOND)
    assert real(rows_of(last)) == rows_of(batch)


@pytest.mark.parametrize("delay", [UNORDERED, 3])
def test_running_visitors_row_by_row(spark, delay):
    rows = random_log(9, n=150, span=300, users=("hot", "b", "c", None, "d", "e"))
    got = op.running_distinct(stream(spark, rows, delay=delay), "user", 100 * SECOND)
    assert [r for r in drained(spark, got, "seq", "window_end", "uv", "is_new") if r[0] < 10**9] == h.running(rows, 100)


def test_running_visitors_after_a_restart(spark):
    """One file per run of the query, each from the checkpoint of the run before."""
    rows = sorted(random_log(10, n=90, span=200), key=by_time)
    path, checkpoint, out = (tempfile.mkdtemp(prefix=p) for p in ("stream-", "checkpoint-", "out-"))
    chunks = [rows[:30], rows[30:60], rows[60:], [sentinel("end")(FAR)], [sentinel("end")(FAR + 1)]]
    for number, chunk in enumerate(chunks):
        frame(spark, chunk, LOG).coalesce(1).write.parquet(f"{path}/{number}")
        live = spark.readStream.schema(frame(spark, [], LOG).schema).parquet(f"{path}/*")
        got = op.running_distinct(op.with_event_time(live, "ts", 2 * SECOND), "user", 100 * SECOND)
        query = (
            got.writeStream.format("parquet").option("path", f"{out}/rows")
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        )
        query.awaitTermination(300)
    found = rows_of(spark.read.parquet(f"{out}/rows"), "seq", "window_end", "uv", "is_new")
    assert [r for r in found if r[0] < 10**9] == h.running(rows, 100)
