"""Net-revenue sales fact and the revenue reports read from it.

Amounts are aggregated to one row per order before any join, so the hash
partitioning by ``order_id`` made for the aggregates serves the joins too and
no join multiplies lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

# Order states that never count as revenue.
CANCELLED_STATES = ("cancelled", "cancelled_inventory", "cancelled_fraud")

ORDER_COLUMNS = (
    "order_id",
    "customer_id",
    "order_date",
    "ship_date",
    "payment_received_date",
    "store_id",
    "channel",
)


def _is_live() -> Column:
    return ~F.col("status").isin(*CANCELLED_STATES)


def of_orders(orders: DataFrame, *inputs: DataFrame) -> list[DataFrame]:
    """The rows of each input that belong to one of the orders."""
    wanted = orders.select("order_id")
    return [rows.join(wanted, "order_id", "left_semi") for rows in inputs]


def gross_revenue_by_order(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Gross amount of every order that has lines and was not cancelled."""
    amounts = items.groupBy("order_id").agg(F.sum(F.col("unit_price") * F.col("qty")).alias("gross_amount"))
    # A null status fails NOT IN as well, so such an order is left out.
    live = orders.filter(_is_live()).select(*ORDER_COLUMNS)
    return live.join(amounts, "order_id").select(*ORDER_COLUMNS, "gross_amount")


def refunds_by_order(refunds: DataFrame) -> DataFrame:
    return refunds.groupBy("order_id").agg(F.sum("refund_amount").alias("total_refunds"))


def discounts_by_order(order_promotions: DataFrame, promotions: DataFrame) -> DataFrame:
    """Bridge rows priced through their promotion, summed per order."""
    priced = order_promotions.select("order_id", "promotion_id").join(
        promotions.select("promotion_id", "discount_amount"), "promotion_id"
    )
    return priced.groupBy("order_id").agg(F.sum("discount_amount").alias("total_discounts"))


def as_of_version(facts: DataFrame, versions: DataFrame, key: str, day: str, *, inclusive_end: bool = False) -> DataFrame:
    """Join each fact row to the version of ``key`` valid on ``day``.

    Versions are half open, [effective_from, effective_to): the day a version
    is closed belongs to its successor. ``inclusive_end`` gives the BETWEEN
    form, where such a day matches both versions and the fact row repeats.
    """
    on_day = F.col(f"f.{day}").cast("date")
    ends = on_day <= F.col("v.effective_to") if inclusive_end else on_day < F.col("v.effective_to")
    condition = (F.col(f"f.{key}") == F.col(f"v.{key}")) & (on_day >= F.col("v.effective_from")) & ends
    joined = facts.alias("f").join(versions.alias("v"), condition)
    extra = [F.col(f"v.{name}") for name in versions.columns if name not in facts.columns]
    return joined.select("f.*", *extra)


def not_yet_loaded(candidates: DataFrame, loaded: DataFrame, key: str = "order_id") -> DataFrame:
    """Candidate rows whose key is absent from the target; null target keys are ignored."""
    return candidates.join(loaded.select(key), key, "left_anti")


def net_revenue_fact(
    orders: DataFrame,
    items: DataFrame,
    refunds: DataFrame,
    order_promotions: DataFrame,
    promotions: DataFrame,
    customer_dim: DataFrame,
    time_dim: DataFrame,
    store_dim: DataFrame,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """New fact rows: net = gross - refunds - discounts, with dimension keys.

    ``loaded`` is the fact as it stands; orders already in it are skipped. The
    headers of the others are stored first, so lines, refunds and bridge rows
    are reduced to them before anything is aggregated, and the planner knows how
    few they are.
    """
    fresh = orders
    if loaded is not None:
        fresh = cut_lineage(not_yet_loaded(orders, loaded))
        items, refunds, order_promotions = of_orders(fresh.filter(_is_live()), items, refunds, order_promotions)
    priced = (
        gross_revenue_by_order(fresh, items)
        .join(refunds_by_order(refunds), "order_id", "left")
        .join(discounts_by_order(order_promotions, promotions), "order_id", "left")
    )
    refund = F.coalesce("total_refunds", F.lit(0))
    discount = F.coalesce("total_discounts", F.lit(0))
    amounts = priced.select(
        *ORDER_COLUMNS,
        F.col("gross_amount").alias("gross_revenue"),
        refund.alias("refund_amount"),
        discount.alias("discount_amount"),
        (F.col("gross_amount") - refund - discount).alias("net_revenue"),
    )
    dated = amounts.join(
        time_dim.select("time_key", F.col("full_date").alias("_day")),
        F.col("order_date").cast("date") == F.col("_day"),
    ).join(store_dim.select("store_id", "store_key"), "store_id")
    versions = customer_dim.select("customer_key", "customer_id", "effective_from", "effective_to")
    return as_of_version(dated, versions, "customer_id", "order_date").select(
        "order_id",
        "customer_key",
        "time_key",
        "store_key",
        "channel",
        "gross_revenue",
        "refund_amount",
        "discount_amount",
        "net_revenue",
        "order_date",
        "ship_date",
        "payment_received_date",
    )


def repair_fact(
    fact: DataFrame,
    changed: DataFrame,
    orders: DataFrame,
    items: DataFrame,
    refunds: DataFrame,
    order_promotions: DataFrame,
    promotions: DataFrame,
    customer_dim: DataFrame,
    time_dim: DataFrame,
    store_dim: DataFrame,
) -> DataFrame:
    """The fact with the rows of ``changed`` orders made again from their sources.

    ``changed`` names orders that were cancelled, refunded or priced anew after
    they were loaded; a cancelled one leaves the fact. Only their lines are read
    into the aggregates.
    """
    touched = cut_lineage(changed.select("order_id").distinct())
    inputs = of_orders(touched, orders, items, refunds, order_promotions)
    again = net_revenue_fact(*inputs, promotions, customer_dim, time_dim, store_dim)
    return fact.join(touched, "order_id", "left_anti").unionByName(again)


def with_payment_time_key(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Second role of the date dimension; a payment outside the calendar keeps a null key."""
    paid = time_dim.select(F.col("time_key").alias("payment_time_key"), F.col("full_date").alias("_paid"))
    return fact.join(paid, F.col("payment_received_date").cast("date") == F.col("_paid"), "left").drop("_paid")


def _by_fiscal_quarter(fact: DataFrame, time_dim: DataFrame, key: str, total: str) -> DataFrame:
    """Sum per day key first: only one row per day reaches the dimension join."""
    daily = fact.groupBy(key).agg(F.sum("net_revenue").alias("_amount"))
    periods = time_dim.select(F.col("time_key").alias(key), "fiscal_quarter", "fiscal_year")
    return (
        daily.join(periods, key)
        .groupBy("fiscal_quarter", "fiscal_year")
        .agg(F.sum("_amount").alias(total))
        .orderBy("fiscal_year", "fiscal_quarter")
    )


def tax_revenue_by_quarter(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Cash basis: revenue falls in the quarter it was paid."""
    return _by_fiscal_quarter(fact, time_dim, "payment_time_key", "revenue_for_tax")


def mgmt_revenue_by_quarter(fact: DataFrame, time_dim: DataFrame) -> DataFrame:
    """Accrual basis: revenue falls in the quarter it was ordered."""
    return _by_fiscal_quarter(fact, time_dim, "time_key", "revenue_for_reporting")


def reconcile_fact(fact: DataFrame, orders: DataFrame, items: DataFrame) -> DataFrame:
    """Cross-check of loaded gross revenue against the source, one row per order id on either side."""
    loaded = fact.groupBy("order_id").agg(F.sum("gross_revenue").alias("fact_gross"))
    source = gross_revenue_by_order(orders, items).select("order_id", F.col("gross_amount").alias("source_gross"))
    both = loaded.join(source, "order_id", "full_outer")
    verdict = (
        F.when(F.col("fact_gross").isNull(), F.lit("MISSING_IN_FACT"))
        .when(F.col("source_gross").isNull(), F.lit("MISSING_IN_SOURCE"))
        .when(F.col("fact_gross") != F.col("source_gross"), F.lit("AMOUNT_MISMATCH"))
        .otherwise(F.lit("MATCH"))
    )
    difference = F.coalesce("fact_gross", F.lit(0)) - F.coalesce("source_gross", F.lit(0))
    return both.select("order_id", "fact_gross", "source_gross", verdict.alias("verdict"), difference.alias("difference"))
