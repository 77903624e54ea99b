"""Every catalog query against its SQL counterpart on the given tables."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points
from tidemark.plans.catalog import QUERIES
from tidemark.plans.oracle import ORACLE

DATA = Path("/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test tables")


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for name in ("events", "orders", "lineitem"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    yield con
    con.close()


def normal(frame):
    frame = frame[sorted(frame.columns)].copy()
    for column in frame:
        if str(frame[column].dtype).startswith("datetime"):
            frame[column] = frame[column].astype("datetime64[us]")
    return frame.sort_values(list(frame.columns)).reset_index(drop=True)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, sql, name):
    got = normal(QUERIES[name](spark, str(DATA)).toPandas())
    want = normal(sql.execute(ORACLE[name]).df())
    pd.testing.assert_frame_equal(got, want, check_dtype=False)


def test_every_query_has_sql_or_a_reason():
    approximate = {"approx_unique_visitors"}
    assert set(QUERIES) - set(ORACLE) == approximate
    assert QUERIES.keys() <= entry_points.queries().keys()
    assert ORACLE.keys() <= entry_points.oracle_sql().keys()


def test_entry(spark):
    assert entry_points.entry(spark).columns == ["item_id", "window_end", "cnt", "rank"]


# Shuffles of each plan: one per change of grouping.
SHUFFLES = {
    "page_views": 1,
    "key_sliding_count": 2,
    "hot_items_topn": 3,
    "consecutive_fail_pairs": 1,
    "create_pay_match": 1,
    "unpaid_orders": 1,
    "unpaid_orders_lookback": 1,
    "order_lifecycle": 1,
    "click_cap_warnings": 1,
    "fail_burst": 1,
    "reconcile_matched": 2,  # one for the first shipment of each order
}


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_shuffles(spark, name):
    text = plan_of(spark, name)
    assert text.count("Exchange hashpartitioning") == SHUFFLES[name]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products(spark, name):
    text = plan_of(spark, name)
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def plan_of(spark, name):
    df = QUERIES[name](spark, str(DATA))
    return df._jdf.queryExecution().executedPlan().toString()


def test_scans_are_pruned(spark):
    text = plan_of(spark, "page_views")
    assert "EqualTo(event_type,view)" in text and "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in text
