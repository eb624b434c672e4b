"""The stored ratings per product, kept up to date from changes instead of from all reviews.

The view holds sums and counts, which can be added to and taken from; averages
are worked out on reading. A change row carries the review before and after it,
as a log with full row images delivers them: an insertion has no row before, a
deletion none after, and a moved or re-rated review retracts the one and adds
the other.

The view is stored in hash buckets of the product, one folder each. A batch
reads and replaces the buckets of the products it names and no others. Each row
remembers the last batch that changed it, so a batch that is tried again after
half its buckets were replaced adds nothing twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions.scalars import guarded_ratio
from ledgerloom.session import cut_lineage
from ledgerloom.sources import tables

BUCKET = "bucket"
#: Folders of the view; a batch collects at most so many bucket numbers.
BUCKETS = 64
SUMS = ("rating_sum", "rating_count", "reviews")


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("product_id"), F.lit(buckets)).cast("int").alias(BUCKET)


def _schema(product: T.DataType) -> T.StructType:
    sums = [T.StructField(name, T.LongType()) for name in SUMS]
    return T.StructType([T.StructField("product_id", product), *sums, T.StructField("applied", T.LongType()), T.StructField(BUCKET, T.IntegerType())])


def _summed(rows: DataFrame) -> DataFrame:
    """Sums per product of signed reviews: added ones have sign 1, retracted ones -1. Partial sums meet map side."""
    given = F.when(F.col("rating").isNotNull(), F.col("sign")).otherwise(F.lit(0))
    return rows.groupBy("product_id").agg(
        F.coalesce(F.sum(F.col("rating") * F.col("sign")), F.lit(0)).cast("bigint").alias("rating_sum"),
        F.sum(given).cast("bigint").alias("rating_count"),
        F.sum("sign").cast("bigint").alias("reviews"),
    )


def build(reviews: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Store the view from all reviews; later batches are numbered from 0. Reviews of no product are left out."""
    signed = reviews.filter("product_id IS NOT NULL").select("product_id", "rating", F.lit(1).alias("sign"))
    rows = _summed(signed).select("product_id", *SUMS, F.lit(-1).cast("bigint").alias("applied"), _bucket(buckets))
    tables.write_partitioned(rows, path, [BUCKET])


def deltas(changes: DataFrame) -> DataFrame:
    """What a batch adds to and takes from each product; rows of no product are left out."""
    side = lambda prefix, sign: F.struct(
        F.col(f"{prefix}_product_id").alias("product_id"), F.col(f"{prefix}_rating").alias("rating"), F.lit(sign).alias("sign")
    )
    sides = changes.select(F.explode(F.array(side("old", -1), side("new", 1))).alias("s")).select("s.*")
    return _summed(sides.filter("product_id IS NOT NULL"))


def stored_rows(spark: SparkSession, path: str, product: T.DataType, only: list[int] | None = None) -> DataFrame:
    """The view as stored; ``only`` names the buckets to read."""
    rows = spark.read.schema(_schema(product)).parquet(path)
    return rows if only is None else rows.filter(F.col(BUCKET).isin(only))


def merged(held: DataFrame, change: DataFrame, batch_id: int) -> DataFrame:
    """Rows of the view after a batch.

    A row the batch has already changed is left as it is. A product without
    reviews stays as an empty row until a later batch rewrites its bucket: a
    batch tried again has to find that it was here.
    """
    both = held.alias("h").join(change.alias("c"), F.col("h.product_id") == F.col("c.product_id"), "full_outer")
    todo = F.col("c.product_id").isNotNull() & ~F.coalesce(F.col("h.applied") >= batch_id, F.lit(False))
    sums = [
        (F.coalesce(f"h.{name}", F.lit(0)) + F.when(todo, F.col(f"c.{name}")).otherwise(F.lit(0))).cast("bigint").alias(name) for name in SUMS
    ]
    applied = F.when(todo, F.lit(batch_id)).otherwise(F.col("h.applied")).cast("bigint")
    after = both.select(F.coalesce("h.product_id", "c.product_id").alias("product_id"), *sums, applied.alias("applied"))
    return after.filter((F.col("reviews") != 0) | (F.col("applied") >= batch_id))


def maintain(path: str, product: T.DataType, buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """Batch handler that folds review changes into the stored view."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        change = cut_lineage(deltas(batch))
        touched = sorted(r[0] for r in change.select(_bucket(buckets)).distinct().collect())
        if not touched:
            return
        held = stored_rows(batch.sparkSession, path, product, touched)
        after = cut_lineage(merged(held, change, batch_id).select("product_id", *SUMS, "applied", _bucket(buckets)))
        tables.replace_partitions(after, path, [BUCKET])

    return handle


def ratings(spark: SparkSession, path: str, product: T.DataType) -> DataFrame:
    """The view as its readers see it: average and number of ratings per product."""
    rows = stored_rows(spark, path, product).filter("reviews > 0")
    return rows.select("product_id", guarded_ratio(F.col("rating_sum"), F.col("rating_count")).alias("avg_rating"), F.col("rating_count").alias("review_count"))
