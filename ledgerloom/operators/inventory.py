"""Stock snapshots and turnover."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import guarded_ratio


def capture_snapshot(inventory: DataFrame, at: datetime) -> DataFrame:
    """Current quantities stamped with the capture time; append it to the day's partition."""
    stamp = F.lit(at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
    return inventory.select(
        "product_id",
        "store_id",
        F.col("quantity_available").alias("quantity_on_hand"),
        stamp.alias("snapshot_time"),
        F.lit(at.date()).alias("snapshot_date"),
    )


def _daily_stock(snapshots: DataFrame) -> DataFrame:
    return snapshots.groupBy("product_id", "snapshot_date").agg(
        F.count("quantity_on_hand").alias("_snaps"), F.sum("quantity_on_hand").alias("_units"), F.count("*").alias("_rows")
    )


def _turnover(grouped: DataFrame) -> DataFrame:
    average = guarded_ratio(F.col("_value"), F.col("_snaps"))
    return grouped.select(
        "product_id",
        "product_name",
        "cogs_proxy",
        average.alias("avg_inventory_value"),
        guarded_ratio(F.col("cogs_proxy"), average).alias("corrected_turnover"),
    )


def inventory_turnover(line_fact: DataFrame, products: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Revenue over average stock value per product that was both sold and counted.

    Each side is reduced to one row per product before the join.
    """
    revenue = line_fact.groupBy("product_key").agg(F.sum("net_revenue").alias("cogs_proxy"))
    stock = snapshots.groupBy("product_id").agg(
        F.sum("quantity_on_hand").alias("_units"), F.count("quantity_on_hand").alias("_snaps")
    )
    joined = revenue.join(products, "product_key").join(stock, "product_id")
    return _turnover(joined.withColumn("_value", F.col("_units") * F.col("unit_cost")))


def inventory_turnover_asis(line_fact: DataFrame, products: DataFrame, snapshots: DataFrame) -> DataFrame:
    """The literal report: a sale matches every snapshot of its day and of the day before.

    Sales and snapshots are counted per product and day, so the pairs are
    multiplied out in arithmetic instead of in rows.
    """
    sales = line_fact.groupBy("product_key", F.col("order_date").cast("date").alias("_day")).agg(
        F.sum("net_revenue").alias("_revenue"), F.count("*").alias("_sales")
    )
    # A snapshot of day d serves sales of d and d + 1.
    serving = _daily_stock(snapshots).withColumn(
        "_day", F.explode(F.array("snapshot_date", F.date_add("snapshot_date", 1)))
    )
    served = serving.groupBy("product_id", "_day").agg(
        F.sum("_snaps").alias("_snaps"), F.sum("_units").alias("_units"), F.sum("_rows").alias("_rows")
    )
    joined = sales.join(products, "product_key").join(served, ["product_id", "_day"])
    return _turnover(
        joined.groupBy("product_id", "product_name").agg(
            F.sum(F.col("_revenue") * F.col("_rows")).alias("cogs_proxy"),
            F.sum(F.col("_units") * F.col("_sales") * F.col("unit_cost")).alias("_value"),
            F.sum(F.col("_snaps") * F.col("_sales")).alias("_snaps"),
        )
    )
