"""From raw documents to packed training sequences, one Parquet table after the other.

Every stage takes what its predecessor kept and, but for the last, returns the columns of
``documents``.  Columns may hold nulls and an empty table stays empty; see each operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import jaccard, line_templates, mixing, pu_quality
from tidemark.llm.queries import packed_pieces
from tidemark.llm.tables import stored, table


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    return pu_quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_recurring_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; those with no line left go."""
    stripped = line_templates.drop_recurring_lines(docs)
    changed = F.col("dropped_lines") > 0
    left = stripped.where(~changed | (F.trim("text") != "") | F.col("text").isNull())
    length = F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    return left.withColumn("n_chars", length).select(*docs.columns)


def one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of every group of similar ones.

    Rows without an id stay; rows that repeat id and text count once.
    """
    similar = jaccard.similar_documents(docs)
    others = similar.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(others, "doc_id", "left_anti").dropDuplicates(["doc_id", "text"]).select(*docs.columns)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; those it leaves out, or without words, go."""
    plan = mixing.fair_queue(docs).where("taken > 0")
    times = plan.groupBy("doc_id", "size").agg(F.max(F.col("taken") / F.col("size")).cast("int").alias("times"))
    # The row is kept as one value, so no column can clash.
    row = F.struct(*[F.col(c) for c in docs.columns]).alias("row")
    rows = docs.select(row, F.col("doc_id").alias("row_id"), mixing.word_count(F.col("text")).alias("row_size"))
    same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_size") == F.col("size"))
    taken = rows.join(times, same).withColumn("turn", F.explode(F.sequence(F.lit(1), F.col("times"))))
    return taken.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences; a document that is taken several times is packed as often."""
    return packed_pieces(docs)


STAGES = [
    ("quality", good_documents),
    ("lines", without_recurring_lines),
    ("near_duplicates", one_of_similar),
    ("mix", mixed_sources),
    ("pack", packed_sequences),
]

#: SQL can't express training and tokenizing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
