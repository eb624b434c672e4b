"""Partitioned table layouts: by store, by month, by hash bucket."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.sources import tables

# The monthly partitions kept, and how many hash partitions.
FIRST_MONTH = date(2025, 7, 1)
END_MONTH = date(2026, 7, 1)
HASH_PARTITIONS = 8

ARCHIVE = "archive"
OVERFLOW = "overflow"


def write_by_list(rows: DataFrame, path: str, column: str) -> DataFrame:
    """Write one folder per value and return the table read back.

    Rows are rebalanced on the partition column: a folder gets few files, and
    adaptive execution splits the value that holds too many rows for one task.
    """
    tables.write_partitioned(rows, path, [column])
    return tables.read_parquet(rows.sparkSession, path, tables.schema_with_last(rows, [column]))


def read_one(table: DataFrame, column: str, value: object) -> DataFrame:
    """Rows of one partition; only its folder is scanned."""
    return table.filter(F.col(column) == value)


def month_partition(day: Column, first: date = FIRST_MONTH, end: date = END_MONTH) -> Column:
    """Partition label of a date: its month inside the kept span, else archive or overflow."""
    value = day.cast("date")
    return (
        F.when(value < F.lit(first), F.lit(ARCHIVE))
        .when(value >= F.lit(end), F.lit(OVERFLOW))
        .otherwise(F.date_format(value, "yyyy-MM"))
    )


def write_by_month(rows: DataFrame, path: str, day: str) -> DataFrame:
    return write_by_list(rows.withColumn("order_month", month_partition(F.col(day))), path, "order_month")


def hash_bucket(key: str, buckets: int = HASH_PARTITIONS) -> Column:
    """Bucket number as Spark's own hash partitioning and bucketed tables assign it."""
    return F.pmod(F.hash(key), F.lit(buckets))


def portable_bucket(key: str, buckets: int = HASH_PARTITIONS) -> Column:
    """Bucket number any engine can compute: the first eight hex digits of the key's MD5, modulo ``buckets``."""
    digits = F.left(F.md5(F.col(key).cast("string")), F.lit(8))
    return F.pmod(F.conv(digits, 16, 10).cast("bigint"), F.lit(buckets))


def hash_partition_counts(rows: DataFrame, key: str, buckets: int = HASH_PARTITIONS) -> DataFrame:
    """Rows per bucket of a table hash-partitioned for several engines; a null key has no bucket."""
    return rows.groupBy(portable_bucket(key, buckets).alias("bucket")).agg(F.count("*").alias("rows"))


def write_bucketed(rows: DataFrame, table: str, path: str, key: str, buckets: int = HASH_PARTITIONS) -> DataFrame:
    """Table bucketed and sorted on ``key``: joins on the key read it without a shuffle."""
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").format("parquet").saveAsTable(table)
    return rows.sparkSession.table(table)


def backfill_if_empty(target: DataFrame, legacy: DataFrame, path: str, column: str) -> DataFrame:
    """Copy the legacy rows into a partitioned table, unless the target already holds any."""
    if not target.isEmpty():
        return target
    return write_by_list(legacy.select(*target.columns), path, column)
