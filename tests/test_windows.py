from datetime import timedelta

import pytest
from helpers import frame, random_log, rows_of, running, sliding_counts
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.operators import windows

SECOND = timedelta(seconds=1)


def counted(df):
    return {(k, end): n for k, end, n in rows_of(df, "k", "window_end", "cnt")}


@pytest.mark.parametrize("size,slide", [(6, 2), (60, 5), (7200, 10), (6, 6), (7, 3)])
def test_sliding_counts(spark, size, slide):
    rows = [(user, ts * 3) for user, _, ts, _ in random_log(1, n=80)]
    got = op.window_count(
        frame(spark, rows, "k string, ts timestamp"), ["k"], size * SECOND, slide * SECOND
    )
    assert counted(got) == sliding_counts(rows, size, slide)


def test_sliding_counts_across_chunks(spark, monkeypatch):
    monkeypatch.setattr(windows, "ENDS_PER_CHUNK", 4)
    rows = [(user, ts) for user, _, ts, _ in random_log(2, n=60, span=90)]
    got = op.window_count(
        frame(spark, rows, "k string, ts timestamp"), ["k"], 8 * SECOND, 2 * SECOND
    )
    assert counted(got) == sliding_counts(rows, 8, 2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    rows=st.lists(st.tuples(st.sampled_from("ab"), st.integers(-500, 500)), min_size=1, max_size=25),
    slide=st.integers(1, 7),
    ratio=st.integers(2, 9),
)
def test_each_row_counts_in_every_covering_window(spark, rows, slide, ratio):
    df = frame(spark, rows, "k string, ts timestamp")
    got = counted(op.window_count(df, ["k"], slide * ratio * SECOND, slide * SECOND))
    assert got == sliding_counts(rows, slide * ratio, slide)
    assert sum(got.values()) == len(rows) * ratio


def test_window_before_1970(spark):
    df = spark.sql("SELECT 'a' AS k, timestamp'1969-12-31 23:59:59' AS ts")
    ends = op.window_count(df, ["k"], 4 * SECOND, 2 * SECOND).orderBy("window_end")
    assert [str(r.window_end) for r in ends.collect()] == [
        "1970-01-01 00:00:00",
        "1970-01-01 00:00:02",
    ]


def test_global_count(spark):
    rows = [(ts,) for _, _, ts, _ in random_log(3)]
    got = op.window_count(frame(spark, rows, "ts timestamp"), [], 10 * SECOND, 5 * SECOND)
    want = sliding_counts([(None, ts) for (ts,) in rows], 10, 5)
    assert {(None, end): n for end, n in rows_of(got, "window_end", "cnt")} == want


def test_plain_timestamps_stay_plain(spark):
    df = frame(spark, [("a", 1)], "k string, ts timestamp")
    df = df.withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    got = op.window_count(df, ["k"], 4 * SECOND, 2 * SECOND)
    assert got.schema["window_end"].dataType.typeName() == "timestamp_ntz"


def test_top_n_breaks_ties_by_key(spark):
    counts = frame(
        spark,
        [("a", 10, 5), ("b", 10, 7), ("c", 10, 5), ("d", 10, 1), ("a", 20, 1)],
        "item string, ts timestamp, cnt bigint",
    ).withColumnRenamed("ts", "window_end")
    got = rows_of(op.top_n(counts, 2, "item"), "window_end", "rank", "item", "cnt")
    assert got == [(10, 1, "b", 7), (10, 2, "a", 5), (20, 1, "a", 1)]


def test_top_n_is_cut_before_the_shuffle(spark):
    df = frame(spark, [("a", 1)], "item string, ts timestamp")
    counts = op.window_count(df, ["item"], 4 * SECOND, 2 * SECOND)
    plan = op.top_n(counts, 3, "item")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_ranking_report(spark):
    top = frame(
        spark, [("b", 0, 7, 1), ("a", 0, 5, 2)], "item string, ts timestamp, cnt bigint, rank int"
    ).withColumnRenamed("ts", "window_end")
    (row,) = op.ranking_report(top, "item", header="item -> n").collect()
    assert row.report == "time: 2023-11-14 22:13:20\nitem -> n\nb -> 7\na -> 5"


def test_distinct(spark):
    rows = [(user, ts) for user, _, ts, _ in random_log(4)]
    df = frame(spark, rows, "user string, ts timestamp")
    got = dict(rows_of(op.window_distinct(df, "user", 20 * SECOND)))
    near = dict(rows_of(op.window_approx_distinct(df, "user", 20 * SECOND, rsd=0.01)))
    users = {}
    for user, ts in rows:
        for (_, end), _ in sliding_counts([(user, ts)], 20, 20).items():
            users.setdefault(end, set()).add(user)
    want = {end: len(found - {None}) for end, found in users.items()}
    assert got == want == near


@pytest.mark.parametrize("slots", [1, 3, 1440])
@pytest.mark.parametrize("seed", [5, 6])
def test_running_distinct(spark, slots, seed):
    rows = random_log(seed, n=90)
    df = frame(spark, rows, "user string, state string, ts timestamp, seq bigint")
    got = op.running_distinct(df, "user", 25 * SECOND, slots=slots)
    assert got.columns == [*df.columns, "window_end", "uv", "is_new"]
    assert rows_of(got, "seq", "window_end", "uv", "is_new") == running(rows, 25)
