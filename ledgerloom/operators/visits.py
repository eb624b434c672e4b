"""Point-of-sale visits and the basket and commission figures built on them.

A new visit starts when more than 15 minute boundaries lie between two
consecutive transactions of one customer in one store. Two transactions in the
same minute can therefore never be split, so transactions are first summed per
minute. That aggregate shrinks map side and bounds what the window sees per
customer and store by the minutes in the period, however hot the customer is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import guarded_ratio, minute_of

# Fixed value: a longer pause starts a new visit.
VISIT_GAP_MINUTES = 15

VISIT_KEY = ("customer_id", "store_id")


def retail_visits(orders: DataFrame, gap_minutes: int = VISIT_GAP_MINUTES) -> DataFrame:
    """One row per visit: customer, store, running number, start, end, count, total."""
    minutes = (
        orders.filter(F.col("channel") == "retail")
        .groupBy(*VISIT_KEY, minute_of(F.col("order_date")).alias("_minute"))
        .agg(
            F.min("order_date").alias("_start"),
            F.max("order_date").alias("_end"),
            F.count("order_id").alias("_count"),
            F.sum("total_amount").alias("_total"),
        )
    )
    timeline = Window.partitionBy(*VISIT_KEY).orderBy("_minute")
    pause = F.col("_minute") - F.lag("_minute").over(timeline)
    # The first minute of a customer in a store has no predecessor and opens a visit.
    flagged = minutes.withColumn("_opens", F.when(pause <= gap_minutes, F.lit(0)).otherwise(F.lit(1)))
    so_far = timeline.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = flagged.withColumn("visit_group", F.sum("_opens").over(so_far))
    return (
        numbered.groupBy(*VISIT_KEY, "visit_group")
        .agg(
            F.min("_start").alias("visit_start"),
            F.max("_end").alias("visit_end"),
            F.sum("_count").alias("transaction_count"),
            F.sum("_total").alias("visit_total"),
        )
        .withColumn("corrected_basket_size", F.col("visit_total"))
    )


def _retail_revenue(fact: DataFrame, store_dim: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Retail net revenue per store and month name; days are summed before the dimension joins."""
    daily = fact.filter(F.col("channel") == "retail").groupBy("store_key", "time_key").agg(F.sum("net_revenue").alias("_amount"))
    return (
        daily.join(store_dim, "store_key")
        .join(time_dim.select("time_key", "month_name"), "time_key")
        .groupBy("store_id", "store_name", "manager_name", "month_name")
        .agg(F.sum("_amount").alias("total_revenue"))
    )


def _visit_counts(visits: DataFrame) -> DataFrame:
    """Visits per store and the month they started in; each visit row is distinct already."""
    return visits.groupBy("store_id", F.date_format("visit_start", "MMMM").alias("month_name")).agg(
        F.count("*").alias("visit_count")
    )


def _revenue_and_visits(fact: DataFrame, visits: DataFrame, store_dim: DataFrame, time_dim: DataFrame) -> DataFrame:
    return (
        _retail_revenue(fact, store_dim, time_dim)
        .join(_visit_counts(visits), ["store_id", "month_name"], "left")
        .withColumn("visit_count", F.coalesce("visit_count", F.lit(0)))
    )


def corrected_basket_size(fact: DataFrame, visits: DataFrame, store_dim: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Revenue per visit by store and month; each side is aggregated before they meet."""
    return (
        _revenue_and_visits(fact, visits, store_dim, time_dim)
        .groupBy("store_name", "month_name")
        .agg(F.sum("total_revenue").alias("total_revenue"), F.sum("visit_count").alias("visit_count"))
        .withColumn("corrected_basket_size", guarded_ratio(F.col("total_revenue"), F.col("visit_count")))
        .orderBy("store_name", "month_name")
    )


def _backpay(grouped: DataFrame) -> DataFrame:
    basket = guarded_ratio(F.col("_revenue"), F.col("_visits"))
    owed = (basket - F.col("reported_basket").cast("double")) * F.col("_rate").cast("double")
    return grouped.select(
        "store_name", "manager_name", basket.alias("corrected_basket"), "reported_basket", owed.alias("underpayment")
    )


def commission_backpay(
    fact: DataFrame, visits: DataFrame, store_dim: DataFrame, time_dim: DataFrame, reported: DataFrame
) -> DataFrame:
    """Commission owed per store manager over the months that were reported."""
    rates = reported.groupBy("store_id", "month_name").agg(
        F.min("reported_basket_size").alias("_reported"), F.min("commission_rate").alias("_rate")
    )
    matched = _revenue_and_visits(fact, visits, store_dim, time_dim).join(rates, ["store_id", "month_name"])
    return _backpay(
        matched.groupBy("store_name", "manager_name").agg(
            F.sum("total_revenue").alias("_revenue"),
            F.sum("visit_count").alias("_visits"),
            F.min("_reported").alias("reported_basket"),
            F.min("_rate").alias("_rate"),
        )
    )


def _repeated_revenue(fact: DataFrame, visits: DataFrame) -> DataFrame:
    """What joining every fact row to every visit of its customer and store adds up to.

    The join repeats a fact row once per visit (once when there is none), and
    visit numbers run 1..n inside each customer and store. So the repeated sum is
    revenue times n, and the distinct visit numbers of any group of fact rows
    are as many as the largest n among them: no row needs to be repeated.
    """
    per_customer = (
        fact.filter(F.col("channel") == "retail")
        .groupBy("customer_key", "store_key", "time_key")
        .agg(F.sum("net_revenue").alias("_amount"))
    )
    visit_totals = visits.groupBy(F.col("customer_id").alias("customer_key"), F.col("store_id").alias("store_key")).agg(
        F.max("visit_group").alias("_n")
    )
    joined = per_customer.join(visit_totals, ["customer_key", "store_key"], "left")
    return joined.groupBy("store_key", "time_key").agg(
        F.sum(F.col("_amount") * F.coalesce("_n", F.lit(1))).alias("_revenue"),
        F.max(F.coalesce("_n", F.lit(0))).alias("_visits"),
    )


def corrected_basket_size_asis(fact: DataFrame, visits: DataFrame, store_dim: DataFrame, time_dim: DataFrame) -> DataFrame:
    """The literal report: fact joined to visits on customer and store keys only."""
    return (
        _repeated_revenue(fact, visits)
        .join(store_dim, "store_key")
        .join(time_dim.select("time_key", "month_name"), "time_key")
        .groupBy("store_name", "month_name")
        .agg(F.sum("_revenue").alias("total_revenue"), F.max("_visits").alias("visit_count"))
        .withColumn("corrected_basket_size", guarded_ratio(F.col("total_revenue"), F.col("visit_count")))
        .orderBy("store_name", "month_name")
    )


def commission_backpay_asis(
    fact: DataFrame, visits: DataFrame, store_dim: DataFrame, time_dim: DataFrame, reported: DataFrame
) -> DataFrame:
    """The literal back-pay report; several report rows for one store and month repeat revenue again."""
    rates = reported.groupBy("store_id", "month_name").agg(
        F.count("*").alias("_reports"),
        F.min("reported_basket_size").alias("_reported"),
        F.min("commission_rate").alias("_rate"),
    )
    matched = (
        _repeated_revenue(fact, visits)
        .join(store_dim, "store_key")
        .join(time_dim.select("time_key", "month_name"), "time_key")
        .join(rates, ["store_id", "month_name"])
    )
    return _backpay(
        matched.groupBy("store_name", "manager_name").agg(
            F.sum(F.col("_revenue") * F.col("_reports")).alias("_revenue"),
            F.max("_visits").alias("_visits"),
            F.min("_reported").alias("reported_basket"),
            F.min("_rate").alias("_rate"),
        )
    )
