"""Instalment-plan status and default rate."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import guarded_ratio

# Status code, category, counts as default, counts as plan.
PLAN_STATUSES = (
    ("active", "active", False, True),
    ("completed", "completed", False, True),
    ("defaulted", "defaulted", True, True),
    ("restructured", "restructured", False, True),
    ("restructured_default", "defaulted", True, True),
    ("reversed", "reversed", False, False),
    ("frozen", "frozen", False, False),
    ("orphan", "orphan", False, False),
)

RECENT_PAYMENT_MONTHS = 2


def plan_status_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(PLAN_STATUSES),
        "status_code string, status_category string, in_default_numerator boolean, in_default_denominator boolean",
    )


def reclassify_plans(plans: DataFrame, customers: DataFrame, as_of: date) -> DataFrame:
    """Plans with ``status_category`` recomputed; the first rule that holds decides.

    Missed payments win over a reversal, and a plan without a customer is an
    orphan only when nothing else applies.
    """
    known = customers.select(F.col("customer_id").alias("_known")).distinct()
    missed = F.col("missed_payment_count") >= F.col("default_threshold")
    restructured = F.col("restructure_date").isNotNull()
    still_paying = F.col("last_payment_date") >= F.add_months(F.lit(as_of).cast("date"), -RECENT_PAYMENT_MONTHS)
    status = (
        F.when(missed & ~restructured, F.lit("defaulted"))
        .when(restructured & still_paying, F.lit("restructured"))
        .when(restructured & missed, F.lit("restructured_default"))
        .when(F.col("reversal_date").isNotNull(), F.lit("reversed"))
        .when(F.col("_known").isNull(), F.lit("orphan"))
        .otherwise(F.col("current_status"))
    )
    return (
        plans.join(known, F.col("customer_id") == F.col("_known"), "left")
        .withColumn("status_category", status)
        .drop("_known")
    )


def plan_default_rate(plans: DataFrame, statuses: DataFrame) -> DataFrame:
    """Defaults over countable plans; plans with a status outside the taxonomy are left out.

    Plans are counted per status first, so the join sees a handful of rows.
    """
    per_status = plans.groupBy("status_category").agg(F.count("*").alias("_plans"))
    flags = statuses.select(F.col("status_code").alias("status_category"), "in_default_numerator", "in_default_denominator")
    defaults = F.sum(F.when(F.col("in_default_numerator"), F.col("_plans")).otherwise(F.lit(0)))
    total = F.sum(F.when(F.col("in_default_denominator"), F.col("_plans")).otherwise(F.lit(0)))
    return (
        per_status.join(flags, "status_category")
        .agg(defaults.alias("defaults"), total.alias("total_plans"))
        .withColumn("corrected_default_rate", guarded_ratio(F.col("defaults"), F.col("total_plans")))
    )


def reserve_overstatement(rate: DataFrame, reported_rate: Decimal, portfolio: Decimal) -> DataFrame:
    """Reserves held against the difference between the reported and the corrected rate."""
    corrected = F.col("defaults").cast("decimal(20,0)") / F.nullif(F.col("total_plans").cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    gap = (F.lit(reported_rate) - corrected).cast("decimal(20,12)")
    return rate.select(
        F.lit(reported_rate).alias("reported_rate"),
        "corrected_default_rate",
        gap.alias("variance"),
        (gap * F.lit(portfolio)).cast("decimal(28,4)").alias("over_provisioned"),
    )
