"""Calendar and history-keeping (type 2) dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import date_key

# End of an open version, and start of a version never sold to.
OPEN_END = "9999-12-31"
FALLBACK_START = "2023-01-01"

CUSTOMER_ATTRIBUTES = ("first_name", "last_name", "email", "city", "province")
TRACKED_ATTRIBUTES = ("city", "province")


def calendar_dim(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day; its size is the span in days, which the planner knows exactly."""
    days = spark.range((last - first).days + 1, numPartitions=1)
    day = F.date_add(F.lit(first), F.col("id").cast("int"))
    return days.select(day.alias("full_date")).select(
        date_key(F.col("full_date")).alias("time_key"),
        "full_date",
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.quarter("full_date").alias("fiscal_quarter"),
        F.year("full_date").alias("fiscal_year"),
    )


def backfill_validity(dim: DataFrame, fact: DataFrame) -> DataFrame:
    """Give a type 1 dimension its validity columns: first sale to the end of time."""
    first_sale = fact.groupBy("customer_key").agg(F.min(F.col("order_date").cast("date")).alias("_first"))
    return (
        dim.drop("effective_from", "effective_to", "is_current")
        .join(first_sale, "customer_key", "left")
        .withColumn("effective_from", F.coalesce("_first", F.lit(FALLBACK_START).cast("date")))
        .withColumn("effective_to", F.lit(OPEN_END).cast("date"))
        .withColumn("is_current", F.lit(True))
        .drop("_first")
    )


def latest_per_key(rows: DataFrame, key: str | list[str], order: list[str]) -> DataFrame:
    """The last row of every key. An aggregate, so repeated keys shrink before the shuffle."""
    keys = [key] if isinstance(key, str) else key
    rest = [name for name in rows.columns if name not in keys]
    picked = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*[name if name in keys else F.col(f"_row.{name}").alias(name) for name in rows.columns])


def apply_scd2_changes(dim: DataFrame, staging: DataFrame, as_of: date, staging_order: list[str] | None = None) -> DataFrame:
    """The dimension after one nightly load.

    A customer whose city or province differs (nulls compare as values) gets the
    current version closed on ``as_of`` and a new one opened that day. Unknown
    customers are added. Everything else passes through unchanged. New rows have
    a null ``customer_key``; the table that stores the dimension assigns it.

    One full outer join on the current versions decides all three outcomes.
    """
    source = staging
    if staging_order:
        source = latest_per_key(staging, "customer_id", staging_order)
    source = source.select("customer_id", *CUSTOMER_ATTRIBUTES)
    # A version that is not known to be current is history.
    is_current = F.coalesce("is_current", F.lit(False))
    history = dim.filter(~is_current)
    current = dim.filter(is_current)
    # A customer with closed versions only is known: it is reopened just when
    # its last version was closed by this very load (a re-run after a failure).
    closed = history.groupBy("customer_id").agg(
        F.max(F.col("effective_to") == F.lit(as_of).cast("date")).alias("_closed_today")
    )
    new_columns = F.struct(*source.columns)
    pairs = current.select(F.struct(*dim.columns).alias("old")).join(
        source.join(closed, "customer_id", "left").select(new_columns.alias("new"), "_closed_today"),
        F.col("old.customer_id") == F.col("new.customer_id"),
        "full_outer",
    )
    differs = F.lit(False)
    for name in TRACKED_ATTRIBUTES:
        differs = differs | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    changed = F.col("old").isNotNull() & F.col("new").isNotNull() & differs
    appears = F.col("old").isNull() & F.coalesce("_closed_today", F.lit(True))

    closing = F.col("old").withField("effective_to", F.lit(as_of).cast("date")).withField("is_current", F.lit(False))
    opened = {
        "customer_key": F.lit(None),
        "effective_from": F.lit(as_of),
        "effective_to": F.lit(OPEN_END),
        "is_current": F.lit(True),
    }
    opening = F.struct(
        *[
            (opened[name] if name in opened else F.col(f"new.{name}")).cast(dim.schema[name].dataType).alias(name)
            for name in dim.columns
        ]
    )
    versions = (
        F.when(changed, F.array(closing, opening))
        .when(appears, F.array(opening))
        .when(F.col("old").isNotNull(), F.array(F.col("old")))
    )
    return history.unionByName(pairs.select(F.inline(versions)))
