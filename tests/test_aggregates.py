"""Aggregates of a user's own and sketches that are stored and merged."""

import random
import statistics
from datetime import timedelta

import pytest
from helpers import frame, random_log, rows_of
from pyspark.sql import functions as F
from streams import as_stream, drain

from tidemark import operators as op
from tidemark.operators import accumulators

SECOND = timedelta(seconds=1)
LOG = "user string, state string, ts timestamp, seq bigint"


def longest_text():
    class Longest:
        """The longest text and how often texts stood, as a user would write it."""

        fields = "text string, n long"
        result_fields = "text string, n long"

        def create(self):
            return None, 0

        def add(self, held, text):
            return self.merge(held, (text, 1))

        def merge(self, held, other):
            texts = [t for t in (held[0], other[0]) if t is not None]
            return max(texts, key=lambda t: (len(t), t), default=None), held[1] + other[1]

        def result(self, held):
            return held

    return Longest()  # a class of this function travels by value


@pytest.mark.parametrize("most_keys", [accumulators.MOST_KEYS, 1])
def test_own_aggregates(spark, monkeypatch, most_keys):
    monkeypatch.setattr(accumulators, "MOST_KEYS", most_keys)
    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "b", None]), rng.choice([None, 1.5, 2.0, 1e6 + rng.random()]), "x" * rng.randrange(9)) for _ in range(500)]
    rows.append(("only null", None, None))
    df = spark.createDataFrame(rows, "k string, v double, t string").repartition(7)
    moments = {r.k: r for r in op.aggregate(df, ["k"], op.Moments(), ["v"]).collect()}
    longest = {r.k: r for r in op.aggregate(df, ["k"], longest_text(), ["t"]).collect()}
    assert moments.keys() == longest.keys() == {r[0] for r in rows}
    for key, got in moments.items():
        values = [v for k, v, _ in rows if k == key and v is not None]
        assert got.n == len(values)
        if values:
            assert got.mean == pytest.approx(statistics.fmean(values), rel=1e-12)
            assert got.variance == pytest.approx(statistics.pvariance(values), rel=1e-9)
        else:
            assert got.mean is None and got.variance is None
        texts = [t for k, _, t in rows if k == key]
        assert (longest[key].text, longest[key].n) == (max((t for t in texts if t is not None), default=None), len(texts))


def test_own_aggregates_are_partial_before_the_shuffle(spark):
    df = spark.range(100_000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v")).repartition(4)
    result = op.aggregate(df, ["k"], op.Moments(), ["v"])
    plan = result._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Exchange hashpartitioning(k", 1)
    assert "MapInArrow" in above and "MapInArrow" in below
    assert sorted(tuple(r)[:2] for r in result.collect()) == [(0, 33334), (1, 33333), (2, 33333)]


def test_own_aggregates_without_keys_or_rows(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "v double")
    assert [tuple(r) for r in op.aggregate(df, [], op.Moments(), ["v"]).collect()] == [(2, 2.0, 1.0)]
    assert op.aggregate(df.where("v > 9"), [], op.Moments(), ["v"]).collect() == []


def test_stored_sketches_roll_up(spark, tmp_path):
    rows = [(f"u{k * 7919 % 3000}", "x", k % 7200, k) for k in range(20_000)] + [(None, "x", 5, -1)]
    df = frame(spark, rows, LOG)
    path = str(tmp_path / "minutes")
    op.window_sketches(df, "user", 60 * SECOND).write.parquet(path)
    minutes = spark.read.parquet(path)
    for size in (60 * SECOND, 3600 * SECOND):
        got = dict(rows_of(op.sketched_counts(op.roll_up(minutes, size))))
        want = dict(rows_of(op.window_distinct(df, "user", size)))
        assert got.keys() == want.keys()
        assert all(abs(got[end] - uv) <= 0.05 * uv for end, uv in want.items())
        straight = dict(rows_of(op.sketched_counts(op.window_sketches(df, "user", size))))
        assert all(abs(got[end] - straight[end]) <= 0.05 * uv for end, uv in want.items())


def test_sketches_of_a_stream(spark):
    rows = random_log(6, n=100, span=100)
    live = as_stream(spark, rows, LOG, lambda ts: ("sentinel", "end", ts, 10**9), 300 * SECOND)
    stored = drain(spark, op.window_sketches(live, "user", 10 * SECOND))
    got = [r for r in rows_of(op.sketched_counts(op.roll_up(stored, 50 * SECOND))) if r[0] < 1000]
    assert got == rows_of(op.window_distinct(frame(spark, rows, LOG), "user", 50 * SECOND))
