import tempfile
from datetime import timedelta

import pytest

from helpers import frame, random_log, rows_of, sliding_counts
from streams import as_stream, drain
from pyspark.sql import functions as F

from tidemark import operators as op
from tidemark.streaming.sinks import print_rows, read_split, read_windows, replace_windows, write_split, write_top_n

SECOND = timedelta(seconds=1)
LOG = "user string, state string, ts timestamp, seq bigint"
LOG_COLUMNS = ["user", "state", "ts", "seq"]


def run(writer):
    checkpoint = tempfile.mkdtemp(prefix="checkpoint-")
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination(300)
    assert query.exception() is None


def test_split_of_a_batch(spark, tmp_path):
    rows = random_log(1)
    capped = op.click_cap(frame(spark, rows, LOG), ["user"], 4)
    path = str(tmp_path / "split")
    write_split(capped, "kind", path, ["pass", "warn", "a=b/c %"])
    for kind in ("pass", "warn"):
        want = rows_of(capped.where(F.col("kind") == kind), "user", "seq")
        assert want and rows_of(read_split(spark, path, kind), "user", "seq") == want
    assert read_split(spark, path, "a=b/c %").columns == LOG_COLUMNS
    assert read_split(spark, path, "a=b/c %").count() == 0
    odd = capped.withColumn("kind", F.lit("a=b/c %"))
    write_split(odd, "kind", path, ["a=b/c %"])
    assert read_split(spark, path, "a=b/c %").count() == capped.count()
    # Every row is written once, and nothing else is left.
    assert spark.read.parquet(f"{path}/rows/all").count() == capped.count()
    assert sorted(p.name for p in (tmp_path / "split").iterdir()) == ["manifests", "rows"]


def test_split_of_a_stream(spark, tmp_path):
    rows = random_log(1)
    stream = as_stream(spark, rows, LOG, lambda ts: ("sentinel", "end", ts, 10**9), 100 * SECOND)
    path = str(tmp_path / "split")
    run(write_split(op.click_cap(stream, ["user"], 4), "kind", path, ["pass", "warn"]))
    capped = op.click_cap(frame(spark, rows, LOG), ["user"], 4)
    for kind in ("pass", "warn"):
        want = rows_of(capped.where(F.col("kind") == kind), "user", "seq")
        got = read_split(spark, path, kind).where("user IS NULL OR user <> 'sentinel'")
        assert rows_of(got, "user", "seq") == want


def test_windows_are_replaced_when_late_rows_come(spark, tmp_path):
    """Rows up to a minute late change the stored counts, and a repeated batch changes nothing."""
    rows = sorted(random_log(4, n=90, span=120), key=lambda r: r[3])  # in no order of time
    live = as_stream(spark, rows, LOG, lambda ts: ("sentinel", "end", ts, 10**9), 200 * SECOND, parts=4)
    counts = op.window_count(live, ["user"], 20 * SECOND, 10 * SECOND)
    path = str(tmp_path / "windows")
    writer = replace_windows(counts, ["user"], path)
    run(writer)
    batch = op.window_count(frame(spark, rows, LOG), ["user"], 20 * SECOND, 10 * SECOND)
    stored = read_windows(spark, path, counts.schema).where("user IS NULL OR user <> 'sentinel'")
    assert rows_of(stored) == rows_of(batch)
    numbers = [r[0] for r in spark.read.parquet(path).select("_batch").distinct().collect()]
    assert len(numbers) > 1
    # Rankings are over whole windows.
    assert rows_of(op.top_n(stored, 2, "user")) == rows_of(op.top_n(batch, 2, "user"))
    assert not (tmp_path / "windows-updates").exists()


def test_a_repeated_batch_changes_nothing(spark, tmp_path):
    path, written = str(tmp_path / "windows"), []
    schema = "user string, window_end timestamp, cnt bigint"
    first = frame(spark, [("a", 10, 1), (None, 10, 2), ("a", 20, 3)], "user string, ts timestamp, cnt bigint")
    second = frame(spark, [("a", 10, 5), ("b", 10, 1), (None, 30, 1)], "user string, ts timestamp, cnt bigint")

    class Stream:  # hands the function to us
        sparkSession = spark
        writeStream = property(lambda self: self)

        def outputMode(self, mode):
            return self

        def foreachBatch(self, write):
            written.append(write)

    replace_windows(Stream(), ["user"], path)
    (write,) = written
    want = [("a", 10, 5), ("a", 20, 3), ("b", 10, 1), (None, 10, 2), (None, 30, 1)]
    for number, batch in ((0, first), (1, second), (1, second)):
        write(batch.withColumnRenamed("ts", "window_end"), number)
    found = read_windows(spark, path, frame(spark, [], schema).schema)
    assert rows_of(found) == want


def test_live_ranking_without_a_batch_sink(spark):
    """Counts that come one by one, and again when they have grown: the last ranks are the batch's."""
    final = [(user, end, cnt) for end in (10, 20) for user, cnt in zip("abcdefg", (5, 9, 9, 2, 7, 1, 4))]
    grown = [(u, e, c) for u, e, cnt in final for c in range(1, cnt + 1, 2)] + final
    grown += [(None, 10, 9)]
    named = "user string, ts timestamp, cnt bigint"
    rows = sorted(grown, key=lambda r: (r[2], str(r[0])))
    live = as_stream(spark, rows, named, lambda ts: ("sentinel", ts, 1), None)
    live = op.with_event_time(live.withColumnRenamed("ts", "window_end"), "window_end", 50 * SECOND)
    found = drain(spark, op.top_n(live, 3, "user"), "update")
    last = found.groupBy("window_end", "rank").agg(F.max("cnt").alias("cnt"))
    counts = {r[:2]: r[2] for r in rows_of(last, "window_end", "rank", "cnt")}
    batch = op.top_n(frame(spark, [*final, (None, 10, 9)], named).withColumnRenamed("ts", "window_end"), 3, "user")
    assert {k: v for k, v in counts.items() if k[0] < 1000} == {(r[0], r[1]): r[2] for r in rows_of(batch, "window_end", "rank", "cnt")}


def test_top_n_of_a_stream(spark, tmp_path):
    rows = random_log(2)
    stream = as_stream(spark, rows, LOG, lambda ts: ("sentinel", "end", ts, 10**9), 100 * SECOND)
    counts = op.window_count(stream, ["user"], 20 * SECOND, 10 * SECOND)
    path = str(tmp_path / "top")
    run(write_top_n(counts, 2, "user", path))
    want = op.top_n(op.window_count(frame(spark, rows, LOG), ["user"], 20 * SECOND, 10 * SECOND), 2, "user")
    got = spark.read.parquet(path + "/*").where("user IS NULL OR user <> 'sentinel'")
    columns = ["window_end", "rank", "user", "cnt"]
    assert rows_of(got, *columns) == rows_of(want, *columns)
    assert sliding_counts([(u, ts) for u, _, ts, _ in rows], 20, 10)


def test_print(spark, capfd):
    assert print_rows(frame(spark, [("a", "x", 1, 1)], LOG)) is None
    assert "|a" in capfd.readouterr().out


def test_a_kind_without_a_path_is_an_error(spark, tmp_path):
    capped = op.click_cap(frame(spark, random_log(1), LOG), ["user"], 4)
    with pytest.raises(Exception, match="no path for the kind warn"):
        write_split(capped, "kind", str(tmp_path / "split"), ["pass"])
