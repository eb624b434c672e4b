"""The operators as named queries over whole tables, and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import (
    archives,
    bk_simhash,
    bpe_stream,
    chosen_path,
    content_sort,
    decontaminate,
    filter_audit,
    language,
    licences,
    line_winnow,
    one_bit,
    ring_shards,
    unigram_count,
)
from ledgerloom.llm.common import table

SHARDS = 8
UNIGRAM_PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def op1_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


def op3_marginal_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"), UNIGRAM_PIECES)


def op4_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unigram_count.count_tokens(table(spark, sf_dir, "documents"), UNIGRAM_PIECES)


def op5_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort.exact_groups(table(spark, sf_dir, "documents"))


def op6_bpe_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_stream.encode_table(table(spark, sf_dir, "documents"), WORD_BPE)


def op7_line_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = line_winnow.delete_repeated(table(spark, sf_dir, "documents"))
    return cleaned.select("doc_id", "n_lines", "n_removed", F.length("text").alias("n_chars_left"), F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"))


def op8_chosen_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.near_duplicates(table(spark, sf_dir, "documents"), like=chosen_path.Likeness(words=2, percent=80))


def op9_ring_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ring_shards.place_on_ring(table(spark, sf_dir, "documents"), SHARDS)


def op10_arc_to_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archives.pages_through_archives(table(spark, sf_dir, "pages"))


def op11_bk_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bk_simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_one_bit_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_bit.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_failing_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_REGISTERED = (
    op1_latent_leaks,
    op2_licence_paragraphs,
    op3_marginal_unigrams,
    op4_viterbi_counts,
    op5_content_sort,
    op6_bpe_transducer,
    op7_line_winnowing,
    op8_chosen_path,
    op9_ring_shards,
    op10_arc_to_warc,
    op11_bk_simhash,
    op12_one_bit_negatives,
    op13_failing_ids,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in _REGISTERED}

ORACLE_SQL: dict[str, str] = {
    "op5_content_sort": content_sort.SQL,
    "op10_arc_to_warc": archives.SQL,
    "op12_one_bit_negatives": one_bit.SQL,
    "op13_failing_ids": filter_audit.SQL,
}
