"""The registered queries against their SQL, and the pipeline stage by stage."""

from pathlib import Path

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_points
import corpus_pipeline
from tidemark.llm.oracle import ORACLE
from tidemark.llm.queries import QUERIES
from tidemark.llm.tables import stored, table

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    sql = duckdb.connect()
    for view in ("documents", "pages", "embeddings", "labels"):
        sql.execute(f"CREATE VIEW {view} AS SELECT * FROM '{DATA}/{view}.parquet'")
    got, want = QUERIES[name](spark, DATA).toPandas(), sql.execute(ORACLE[name]).df()
    columns = sorted(got.columns)
    sort = lambda frame: frame[columns].sort_values(columns).reset_index(drop=True)
    pd.testing.assert_frame_equal(sort(got), sort(want), check_dtype=False)


def test_all_are_registered():
    assert QUERIES.keys() | {"pipeline"} <= entry_points.queries().keys()
    assert sorted(int(name[2:].split("_")[0]) for name in QUERIES) == list(range(1, len(QUERIES) + 1))


def test_pipeline_stages(spark):
    docs = table(spark, DATA, "documents")
    columns, counts = docs.columns, [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, DATA), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] > counts[3]
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, DATA)
    fills = pieces.groupBy("sequence_id").agg({"length": "sum"}).collect()
    assert max(r[1] for r in fills) == 2048
    assert {r.doc_id for r in pieces.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}


def test_stages_with_clashing_columns(spark):
    good = "This is a plain sentence that goes on for a while. It has another one behind it, and more."
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    names = ("times", "size", "taken", "row", "turn", "key", "drops", "_masked", "_size", "score", "target")
    docs = spark.createDataFrame([(1, good, "en", "a", 90), (2, good[::-1], "en", "b", 90)], schema)
    docs = docs.withColumns({name: F.lit("x") for name in names})
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        docs = stored(stage(spark, docs, DATA), name)
        assert docs.columns == [*schema.replace("string", "").replace("long", "").replace(",", "").split(), *names]
    # The mix leaves out the document that reaches beyond its budget.
    assert {r.doc_id for r in docs.collect()} in ({1}, {2}, {1, 2})


def test_stages_with_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    good = "This is a plain sentence that goes on for a while. It has another one behind it, and more."
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, good, "en", "a", 90), (3, good, "en", "a", 90), (None, good, None, None, 90), (4, good.upper(), "en", "b", 90)]
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[1:-1]:
            docs = stored(stage(spark, docs, DATA), name)
            assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        ids = {r.doc_id for r in docs.collect()}
        assert ids == ({3, None} if given else set())
        assert corpus_pipeline.STAGES[-1][1](spark, docs, DATA).where("length > 2048").count() == 0
