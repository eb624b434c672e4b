"""Change log between two snapshots and finding-driven events."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _image(prefix: str, columns: list[str]) -> Column:
    return F.to_json(F.struct(*[F.col(f"{prefix}.{name}").alias(name) for name in columns]), {"ignoreNullFields": "false"})


def change_log(
    before: DataFrame, after: DataFrame, key: str, table: str, *, changed_by: str | None = None, changed_at: datetime | None = None
) -> DataFrame:
    """INSERT, UPDATE and DELETE rows with JSON images; equal rows leave no trace.

    Rows are compared before any image is built, so JSON is written for changes
    only. Who and when are recorded if given.
    """
    columns = before.columns
    pairs = before.select(F.struct(*columns).alias("old")).join(
        after.select(F.struct(*columns).alias("new")), F.col(f"old.{key}") == F.col(f"new.{key}"), "full_outer"
    )
    stamps = []
    if changed_by is not None:
        stamps.append(F.lit(changed_by).alias("changed_by"))
    if changed_at is not None:
        stamps.append(F.lit(changed_at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz").alias("changed_at"))
    return log_rows(pairs, columns, key, table, stamps)


def log_rows(pairs: DataFrame, columns: list[str], key: str, table: str, more: list[Column]) -> DataFrame:
    """A log row for each pair of structs ``old`` and ``new`` that differ; null stands for no row."""
    changed = pairs.filter(~F.col("old").eqNullSafe(F.col("new")))
    action = (
        F.when(F.col("old").isNull(), F.lit("INSERT")).when(F.col("new").isNull(), F.lit("DELETE")).otherwise(F.lit("UPDATE"))
    )
    return changed.select(
        F.lit(table).alias("table_name"),
        action.alias("action_name"),
        F.coalesce(f"new.{key}", f"old.{key}").cast("string").alias("record_id"),
        F.when(F.col("old").isNotNull(), _image("old", columns)).alias("old_data"),
        F.when(F.col("new").isNotNull(), _image("new", columns)).alias("new_data"),
        *more,
    )


def event_if_any(findings: DataFrame, event_type: str, description: str, severity: str) -> DataFrame:
    """One constant event when there is at least one finding, else no row."""
    return findings.limit(1).select(
        F.lit(event_type).alias("event_type"), F.lit(description).alias("description"), F.lit(severity).alias("severity")
    )
