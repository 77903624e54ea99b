"""Exact duplicates by content-defined chunk recipes, in built-in expressions only.

A text is cut where its own content says so, so equal passages give equal chunks wherever they
stand.  Chunks are deduplicated to identifiers, and the identifiers are verified: the bytes of
every distinct chunk meet once, and the run fails if one identifier stands for two chunks.
After that a document is its ordered list of identifiers, and only such lists are compared.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import fold_ascii, spread_lookup, stored

#: A chunk has at least this many characters (but for the last) and ends after the first
#: sentence end or line end beyond them; without one it ends at the largest length.
SHORTEST, LONGEST = 512, 4096


def chunks_of(text: Column, shortest: int = SHORTEST, longest: int = LONGEST) -> Column:
    """The chunks of a text in order; joined they are the text."""
    cut = rf"(?s).{{{shortest},{longest - 2}}}?(?:[.!?。！？]\s|\n)|.{{1,{longest}}}"
    return F.regexp_extract_all(text, F.lit(cut), F.lit(0))


def identifier(chunk: Column) -> Column:
    return F.unhex(F.sha2(chunk, 256))


def folded_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), fold_ascii(text).alias("folded"))


def chunk_dictionary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every distinct chunk once: ``chunk_id``, ``chunk``."""
    chunks = folded_texts(docs, id_col, text_col).select(F.explode(chunks_of(F.col("folded"))).alias("chunk"))
    return chunks.select(identifier(F.col("chunk")).alias("chunk_id"), "chunk").distinct()


def chunk_recipes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``text_sha256`` of the folded text, and its ``recipe`` of chunk identifiers."""
    return folded_texts(docs, id_col, text_col).select(
        "doc_id",
        F.sha2("folded", 256).alias("text_sha256"),
        F.transform(chunks_of(F.col("folded")), identifier).alias("recipe"),
    )


def exact_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when identical after lower-casing A-Z; the largest id of equal texts stays.
    A null text counts as empty.  Null ids come before all others; rows that repeat the id that
    stays all stay.  An empty table gives an empty result; other columns are not read.
    """
    recipes = stored(chunk_recipes(docs, id_col, text_col), "recipes")
    identifiers = chunk_dictionary(docs, id_col, text_col).groupBy("chunk_id").count()
    ambiguous = identifiers.where("count > 1").agg(F.count("*")).scalar()
    groups = (
        recipes.groupBy("recipe")
        .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
        .where("group_size > 1")
        .where(F.assert_true(ambiguous == 0, "one chunk identifier stands for two chunks").isNull())
    )
    keep_id = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return spread_lookup(recipes, groups, ["recipe"], by="doc_id").select(
        "doc_id",
        keep_id.alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        F.col("doc_id").eqNullSafe(keep_id).alias("kept"),
        "text_sha256",
    )
