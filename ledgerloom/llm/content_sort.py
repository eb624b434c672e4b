"""Exact deduplication by sorting content.

Sampled splitters deal the normalised texts into ranges, every range is sorted
(spilling to disk as needed), and a text is compared in full with the one
before it. Equal texts form a run, and the first row of a run is the one that
stays. The splitters cut at (leading bytes, SHA-256, part), so what the driver
samples is short however long the texts are; texts that share both are still
told apart by the full comparison.

A text with more rows than a ``max_hot``-th of the table is dealt in parts of
that size. There are fewer than ``max_hot`` such texts and fewer than
``2 * max_hot`` parts, whatever the table holds, so the parts' first rows can be
compared in a second, small sort and the outcome broadcast.

Everything is DataFrame operations; no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerloom.llm.common import squeezed, whole_text
from ledgerloom.session import cut_lineage

LEAD_CHARS = 16
MAX_HOT = 10_000
LEAST_PART = 256


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_hot: int = MAX_HOT, least_part: int = LEAST_PART) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical without white space. The row with the most
    code points in its original text stays, then the smallest id; a null id
    comes last. Null and empty texts are one group. Of rows that repeat in full
    exactly one has ``kept``. Other columns of ``docs`` are not looked at. An
    empty table gives an empty result.
    """
    keyed = docs.select(
        F.col(id_col).alias("doc_id"),
        squeezed(whole_text(text_col)).alias("content"),
        F.length(whole_text(text_col)).alias("points"),
    ).withColumn("digest", F.sha2(F.col("content").cast("binary"), 256))
    hot = _hot_texts(keyed, docs.count(), max_hot, least_part)
    dealt = (
        keyed.join(F.broadcast(hot), "digest", "left")
        .withColumn("parts", F.coalesce("parts", F.lit(1)))
        .withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")))
        .withColumn("lead", F.substring("content", 1, LEAD_CHARS))
    )
    place = ["lead", "digest", "part"]
    best_first = [F.col("points").desc(), F.col("doc_id").asc_nulls_last()]
    in_order = W.partitionBy(*place).orderBy("content", *best_first)
    before = F.lag("content").over(in_order)
    # The range partitioning on `place` already keeps a window together; only a sort is added.
    compared = dealt.repartitionByRange(*place).withColumn("first", before.isNull() | (before != F.col("content")))
    runs = compared.withColumn("run", F.sum(F.col("first").cast("int")).over(in_order)).select(
        *place, "run", "doc_id", "points", "first", "parts",
        # Only the parts of hot texts meet again, so only their first rows keep the text.
        F.when(F.col("first") & (F.col("parts") > 1), F.col("content")).alias("content"),
    )
    run = W.partitionBy(*place, "run")
    stored = cut_lineage(
        runs.withColumn("size", F.count(F.lit(1)).over(run))
        .withColumn("head", F.max(F.when(F.col("first"), F.struct("doc_id"))).over(run))
        .drop("lead")
    )
    merged = _merge_parts(stored, best_first)
    key = ["digest", "part", "run"]
    return stored.join(F.broadcast(merged), key, "left").select(
        "doc_id",
        F.when(F.col("all_size").isNull(), F.col("head.doc_id")).otherwise(F.col("all_head.doc_id")).alias("keep_id"),
        F.coalesce("all_size", "size").cast("bigint").alias("group_size"),
        (F.col("first") & F.coalesce("leads", F.lit(True))).alias("kept"),
        F.col("digest").alias("text_sha256"),
    )


def _hot_texts(keyed: DataFrame, rows: int, max_hot: int, least_part: int) -> DataFrame:
    """Digests of more than ``rows / max_hot`` rows, with the number of parts to deal them in."""
    part_rows = max(-(-rows // max_hot), least_part)
    return (
        keyed.groupBy("digest")
        .agg(F.count(F.lit(1)).alias("rows"))
        .filter(F.col("rows") > part_rows)
        .select("digest", F.ceil(F.col("rows") / part_rows).alias("parts"))
    )


def _merge_parts(stored: DataFrame, best_first: list) -> DataFrame:
    """Runs of hot texts with what they are once the parts have met: at most a few for each part."""
    heads = stored.filter(F.col("first") & (F.col("parts") > 1))
    in_order = W.partitionBy("digest").orderBy("content", *best_first)
    before = F.lag("content").over(in_order)
    ordered = heads.withColumn("leads", before.isNull() | (before != F.col("content"))).withColumn(
        "text_no", F.sum(F.col("leads").cast("int")).over(in_order)
    )
    text = W.partitionBy("digest", "text_no")
    return ordered.select(
        "digest", "part", "run", "leads",
        F.sum("size").over(text).alias("all_size"),
        F.max(F.when(F.col("leads"), F.struct("doc_id"))).over(text).alias("all_head"),
    )


#: DuckDB SQL for the query's rows.
SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), r AS (
  SELECT doc_id, content,
         first_value(doc_id) OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size,
         row_number() OVER (PARTITION BY content ORDER BY length(text) DESC, doc_id) = 1 AS kept
  FROM d
)
SELECT doc_id, keep_id, group_size, kept, sha256(content) AS text_sha256 FROM r
"""
