"""The operators over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chunk_dedup,
    collocations,
    conversations,
    curves,
    jaccard,
    line_templates,
    mixing,
    packing,
    pu_quality,
    sentence_spans,
    suffix_parse,
    url_rules,
    warc,
)
from tidemark.llm.tables import table


def op1_shifted_curves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curves.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 50 == 0)


def op2_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_dedup.exact_duplicates(table(spark, sf_dir, "documents"))


def op3_dictionary_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pu_quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_template_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_templates.drop_recurring_lines(table(spark, sf_dir, "documents"))


def op6_sentence_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated_passages(table(spark, sf_dir, "documents"))


def op7_set_relation_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(table(spark, sf_dir, "documents"))


def op8_fair_queue_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.fair_queue(table(spark, sf_dir, "documents"))


HOST_RULES = (
    url_rules.host_rule("net/", "block"),
    url_rules.host_rule("example.net/en/", "allow"),
    url_rules.host_rule("example.com/de/", "block"),
    url_rules.host_rule("org/fr/", "allow"),
)


def op9_url_rule_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), HOST_RULES + url_rules.DEFAULT_RULES)


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Pieces of packed documents with the CRC of their ids in place of the ids."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json")).select(
        "doc_id",
        "start",
        (F.octet_length("ids") / 4).cast("long").alias("length"),
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


def op10_square_sum_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_pieces(table(spark, sf_dir, "documents"))


def op11_prefix_free_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix_parse.remove_repeated_strings(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda total, span: total + span["length"])
    return done.select(
        "doc_id",
        (F.octet_length("kept") + removed).alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_count_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op13_shared_suffix_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.audit_damage(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_shifted_curves,
        op2_chunk_recipe_dedup,
        op3_dictionary_warc,
        op4_pu_quality,
        op5_template_line_dedup,
        op6_sentence_span_dedup,
        op7_set_relation_join,
        op8_fair_queue_mix,
        op9_url_rule_filter,
        op10_square_sum_packing,
        op11_prefix_free_parse,
        op12_count_automata,
        op13_shared_suffix_repair,
    )
}
