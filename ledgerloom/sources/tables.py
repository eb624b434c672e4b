"""Readers and writers. Writers never overwrite a path a plan may still be reading."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# The columns of the load tester's statistics file the report uses.
LOAD_STATS_COLUMNS = ("Name", "Request Count", "Failure Count", "Median Response Time", "99%")


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def schema_with_last(rows: DataFrame, columns: Sequence[str]) -> T.StructType:
    """Schema of ``rows`` with partition columns at the end, as a partitioned read returns it."""
    kept = [f for f in rows.schema.fields if f.name not in columns]
    return T.StructType(kept + [rows.schema[name] for name in columns])


def read_load_stats(spark: SparkSession, path: str) -> DataFrame:
    """Load-test statistics CSV. All columns are text; the report decides what is readable."""
    return spark.read.csv(path, header=True).select(*[f"`{name}`" for name in LOAD_STATS_COLUMNS])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    split_on: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A table of another database. Filters and columns are pushed to it; ``split_on`` reads in parallel."""
    options = {"properties": properties or {}}
    if split_on is None:
        return spark.read.jdbc(url, table, **options)
    return spark.read.jdbc(url, table, column=split_on, lowerBound=lower, upperBound=upper, numPartitions=partitions, **options)


def append(rows: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    rows.write.mode("append").partitionBy(*partition_by).parquet(path)


def replace_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write the partitions ``rows`` falls into and leave all others alone, so a repeated run adds nothing."""
    rows.hint("rebalance", *partition_by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        *partition_by
    ).parquet(path)


def write_new(rows: DataFrame, path: str) -> DataFrame:
    """Write to a fresh path (an existing one is an error) and return the stored table."""
    rows.write.mode("error").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def write_partitioned(rows: DataFrame, path: str, columns: Sequence[str]) -> None:
    rows.hint("rebalance", *columns).write.mode("error").partitionBy(*columns).parquet(path)


def store_view(rows: DataFrame, table: str) -> DataFrame:
    """Materialise a result under a name of the catalogue, with statistics for the planner.

    Each refresh is a table of its own and the name is then pointed at it, so a
    plan that reads the one before goes on reading it. ``drop_refreshes`` removes
    those nobody reads any more.
    """
    spark, stored = rows.sparkSession, f"{table}_{uuid.uuid4().hex}"
    rows.write.mode("error").saveAsTable(stored)
    spark.sql(f"ANALYZE TABLE {stored} COMPUTE STATISTICS FOR ALL COLUMNS")
    spark.sql(f"CREATE OR REPLACE VIEW {table} AS SELECT * FROM {stored}")
    return spark.table(stored)


def drop_refreshes(spark: SparkSession, table: str, keep: DataFrame | None = None) -> None:
    """Drop the refreshes of a stored view; without ``keep``, the refresh still in use, the name goes as well."""
    in_use = set() if keep is None else {file.split("/")[-2] for file in keep.inputFiles()}
    if keep is None:
        spark.sql(f"DROP VIEW IF EXISTS {table}")
    refresh = re.compile(re.escape(table) + "_[0-9a-f]{32}")
    for found in spark.catalog.listTables():
        if refresh.fullmatch(found.name) and found.name not in in_use:
            spark.sql(f"DROP TABLE {found.name}")
