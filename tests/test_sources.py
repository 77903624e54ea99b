import os
from collections import Counter
from datetime import timedelta

import pytest
from helpers import rows_of
from pyspark.sql import functions as F
from streams import drained

from tidemark import functions as times
from tidemark import operators as op
from tidemark.sources import (
    AD_CLICK,
    BEHAVIOR,
    KEY_TIME,
    LOGIN,
    MARKET,
    ORDER,
    RECEIPT,
    accepted,
    read_access_log,
    read_events,
    read_lines,
    read_parsed,
    rejected,
)
from tidemark.sources.readers import parse_access_log, parse_lines, parse_mixed

BASE = 1_700_000_000


@pytest.fixture
def log(tmp_path):
    def write(*lines):
        path = tmp_path / "log"
        path.write_text("\n".join(lines))
        return str(path)

    return write


@pytest.mark.parametrize(
    "fmt,line,want",
    [
        (BEHAVIOR, f"1, 2,3 ,pv,{BASE}", (1, 2, 3, "pv", 0)),
        (AD_CLICK, f"1,2,beijing, beijing ,{BASE}", (1, 2, "beijing", "beijing", 0)),
        (LOGIN, f"1,10.0.0.1,fail,{BASE + 1}", (1, "10.0.0.1", "fail", 1)),
        (ORDER, f"1,create,,{BASE}", (1, "create", None, 0)),
        (ORDER, f"1,pay,x1,{BASE}", (1, "pay", "x1", 0)),
        (RECEIPT, f"x1,wechat,{BASE}", ("x1", "wechat", 0)),
        (MARKET, f"1,AppStore,{BASE}250,Click", (1, "AppStore", 0.25, "Click")),
        (KEY_TIME, f"a {BASE}", ("a", 0)),
    ],
)
def test_formats(spark, log, fmt, line, want):
    df = read_events(spark, log(line), fmt)
    assert df.columns == [name for name, _ in fmt.fields]
    assert rows_of(df) == [want]


def test_malformed_lines_are_kept_apart(spark, log):
    good = f"1,create,,{BASE}"
    bad = ["", "x,create,,1", "1,create", f"1,,p,{BASE}", "1,pay,p,soon"]
    parsed = read_parsed(spark, log(good, *bad, good), ORDER)
    assert accepted(parsed).count() == 2
    assert sorted(r.line for r in rejected(parsed).collect()) == sorted(bad)


@pytest.mark.parametrize("streaming", [False, True])
def test_directories_keep_the_order_of_paths_and_lines(spark, tmp_path, streaming):
    (tmp_path / "a.log").write_text(f"0,ip,fail,{BASE}")
    (tmp_path / "b.log").write_text("\n".join(f"{i},ip,fail,{BASE}" for i in range(1, 51)))
    (tmp_path / "c.log").write_text(f"51,ip,fail,{BASE}\n52,ip,fail,{BASE}")
    df = read_events(spark, str(tmp_path), LOGIN, streaming, seq="seq")
    if streaming:
        query = df.writeStream.format("memory").queryName("placed").trigger(availableNow=True).start()
        query.awaitTermination(60)
        df = spark.table("placed")
    assert [r.user_id for r in df.orderBy("seq").collect()] == list(range(53))


def test_from_a_directory_to_bursts(spark, tmp_path):
    """The reader's stream goes straight into a sequence operator."""
    for n, times in enumerate(([0, 1, 2], [5, 5, 90], [200])):
        lines = [f"7,ip,{'success' if t == 90 else 'fail'},{BASE + t}" for t in times]
        (tmp_path / f"{n}.log").write_text("\n".join(lines))
        os.utime(tmp_path / f"{n}.log", (BASE + n, BASE + n))
    found = []
    for streaming in (False, True):
        logins = op.with_event_time(read_events(spark, str(tmp_path), LOGIN, streaming, seq="seq"), "ts")
        bursts = op.fail_burst(logins, ["user_id"], F.col("state") == "fail", timedelta(seconds=2))
        found.append(drained(spark, bursts) if streaming else rows_of(bursts))
    assert found[0] == found[1] == [(7, 0, 2, 3), (7, 5, 5, 2)]


@pytest.mark.parametrize("fmt,line", [
    (ORDER, "1,pay,p,{}"), (MARKET, "1,AppStore,{},Click"), (KEY_TIME, "a {}"), (LOGIN, "1,ip,fail,{}"),
    (RECEIPT, "x1,wechat,{}"), (AD_CLICK, "1,2,beijing,beijing,{}"), (BEHAVIOR, "1,2,3,pv,{}"),
])
def test_times_out_of_range_are_rejects(spark, log, fmt, line):
    times = ["1558430842000000000", str(2**63 - 1), str(-(2**63)), "9" * 30, "", "-", "1e3x"]
    parsed = read_parsed(spark, log(line.format(BASE), *map(line.format, times)), fmt)
    assert accepted(parsed).count() == 1
    assert sorted(r.line for r in rejected(parsed).collect()) == sorted(map(line.format, times))


def test_times_before_the_epoch(spark, log):
    assert rows_of(read_events(spark, log("a -1", "b 0"), KEY_TIME)) == [("a", -1 - BASE), ("b", -BASE)]


def test_file_order_is_numbered(spark, log):
    df = read_events(spark, log(*[f"{i},ip,fail,{BASE}" for i in range(5)]), LOGIN, seq="seq")
    assert [r.user_id for r in df.orderBy("seq").collect()] == list(range(5))


def test_access_log(spark, log):
    path = log(
        "10.0.0.1 - - 17/05/2015:10:05:03 +0000 GET /a/b",
        "10.0.0.2 - - never +0000 GET /c",
        "10.0.0.3 - - 17/05/2015:10:05:04",
    )
    (row,) = read_access_log(spark, path).collect()
    assert (row.ip, str(row.ts), row.url) == ("10.0.0.1", "2015-05-17 10:05:03", "/a/b")
    assert rejected(parse_access_log(read_lines(spark, path))).count() == 2


def test_empty_file(spark, log):
    assert read_events(spark, log(), LOGIN).count() == 0


def test_streams_read_the_same_records(spark, tmp_path):
    (tmp_path / "a.log").write_text(f"1,ip,fail,{BASE}\nbroken")
    stream = read_events(spark, str(tmp_path), LOGIN, streaming=True)
    query = stream.writeStream.format("memory").queryName("logins").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert rows_of(spark.table("logins")) == [(1, "ip", "fail", 0)]


def test_lines_are_parsed_once(spark, log):
    df = read_access_log(spark, log("10.0.0.1 - - 17/05/2015:10:05:03 +0000 GET /a/b"))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") == 1 and plan.count("dd/MM/yyyy") == 1


def test_times(spark):
    df = spark.sql("SELECT timestamp'2024-02-28 23:59:59.5' AS ts, timestamp'1969-12-31 12:00:00' AS old")
    row = df.select(
        times.day_start(df.ts).alias("day"),
        times.next_midnight(df.ts).alias("next"),
        times.day_start(df.old).alias("old"),
    ).first()
    assert [str(v) for v in row] == [
        "2024-02-28 00:00:00",
        "2024-02-29 00:00:00",
        "1969-12-31 00:00:00",
    ]


def test_lines_of_several_formats(spark):
    """Each line is parsed by the format it names, as that format alone would."""
    formats = (LOGIN, ORDER, KEY_TIME)
    good = {LOGIN: "7,10.0.0.1,fail,1700000000", ORDER: "5,pay,p1,1700000000", KEY_TIME: "a 1700000000000"}
    lines = [(fmt.name, line) for fmt in formats for line in (good[fmt], "", "x", good[LOGIN], good[ORDER], None)]
    lines += [("other", good[LOGIN]), (None, good[LOGIN])]
    mixed = parse_mixed(spark.createDataFrame(lines, "format string, value string"), formats)
    for fmt in formats:
        of_format = mixed.where(F.col("format") == fmt.name)
        alone = parse_lines(spark.createDataFrame([(v,) for f, v in lines if f == fmt.name], "value string"), fmt)
        names = [name for name, _ in fmt.fields]
        got = of_format.select(*[F.col(f"{fmt.name}.{n}").alias(n) for n in names], "_line", "_rejected").collect()
        assert Counter(map(tuple, got)) == Counter(map(tuple, alone.select(*names, "_line", "_rejected").collect()))
    unknown = mixed.where("format = 'other' OR format IS NULL").collect()
    assert [r._rejected for r in unknown] == [True, True]
