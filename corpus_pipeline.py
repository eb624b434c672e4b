"""A training corpus from raw documents: five stages, each stored before the next reads it.

language -> lines -> near duplicates -> benchmark -> tokens. Every stage but the
last returns the columns of ``documents`` and works on all that its predecessor
kept. Columns of ``documents`` beyond the known ones are carried along, whatever
their names.

All stages decide row by row or text by text, never by id: rows with a null id or
the id of another row are documents like others, and no row leaves a stage more
often than it came in. Texts are read whole, however long. A stage without rows
returns none.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe_stream, chosen_path, decontaminate, language, line_winnow
from ledgerloom.llm.common import fresh, table
from ledgerloom.session import cut_lineage, released_scratch

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
LIKE = chosen_path.Likeness(words=5, percent=80)
#: Documents that go to a Python worker at once. Whole texts vary in length a thousandfold, and every worker holds a batch.
BATCH = "1000"


def _in_small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language; those that are undetermined (null, empty, or without a letter) go.

    ``lang`` stays as it was given; a null one is filled with the prediction.
    """
    _in_small_batches(spark)
    found = fresh(docs, "found")
    told = language.with_language(docs, language.learn(docs, PIECES), found)
    kept = told.filter(F.col(found) != language.UNDETERMINED)
    return kept.withColumn("lang", F.coalesce("lang", found)).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier one holds; those with nothing left go.

    ``n_chars`` follows the text where it was given. Null and empty texts have no
    passage and stay. Rows that share id and text are one document to the search
    and get the same result.
    """
    _in_small_batches(spark)
    stretches = line_winnow.repeated_stretches(docs)
    return line_winnow.apply_stretches(docs, stretches)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, that with the smallest id, a null id last.

    Equal texts come down to one row first, partly before they are moved, so a
    large group of copies is no large group later; the search then is among
    different texts. Texts without a word are in no group and stay, null ones
    included. Then passages of over 50 words that an earlier document holds go,
    wherever in its lines they begin; before, they would cut near copies up that
    are to be dropped.
    """
    _in_small_batches(spark)
    key, row, of = fresh(docs, "text_key"), fresh(docs, "kept_row"), fresh(docs, "of_key")
    worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    first = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64(*docs.columns))
    keyed = docs.filter(worded).withColumn(key, F.xxhash64("text"))
    with released_scratch(spark) as keep:
        single = cut_lineage(keyed.groupBy(key).agg(F.min_by(F.struct(*docs.columns), first).alias(row)).select(key, f"{row}.*"))
        groups = chosen_path.near_duplicates(single, id_col=key, like=LIKE).select(F.col("doc_id").alias(of), "component_id")
        members = single.select(F.col("doc_id").alias("id"), F.col(key).alias("member")).join(groups, F.col("member") == F.col(of))
        stays = members.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull(), "id", "member")).alias("first"))
        stays = cut_lineage(stays.select(F.col("first.member").alias(of)))
        kept = single.join(stays, F.col(key) == F.col(of), "left_semi").select(*docs.columns)
        left = keep(kept.unionByName(docs.filter(~worded)))
    return line_winnow.apply_words(left)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in whose text no benchmark item was found; null and empty texts hold none."""
    _in_small_batches(spark)
    key, leaking = fresh(docs, "text_key"), fresh(docs, "leaking")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    with released_scratch(spark) as keep:
        leaks = decontaminate.find_leaks(keyed, table(spark, sf_dir, "benchmark"), id_col=key)
        leaks = keep(leaks.select(F.col("doc_id").alias(leaking)).distinct())
    return keyed.join(leaks, F.col(key) == F.col(leaking), "left_anti").select(*docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens and digests of the token ids and of the decoded text, a row for every document left; a null text has no token."""
    _in_small_batches(spark)
    return bpe_stream.encode_table(docs, WORD_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("MinHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", benchmark_stage),
    ("BPE encoding and decoding", token_stage),
]

#: Learned and iterative stages have no SQL; tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over ``documents``; each result is stored as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES, 1):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES):
            docs = cut_lineage(docs)
    return docs
