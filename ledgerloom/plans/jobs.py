"""Jobs in the order they are run: the nightly warehouse load and the clean-up packs.

Every step stores its tables under a root folder and the next step reads them
back, so a failed run is resumed at the step that failed.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.operators import dimensions, facts, folds, inventory, json_clean, privacy, quality, serving
from ledgerloom.session import cut_lineage, remove_path
from ledgerloom.sources import tables

FACT_MONTH = "order_month"


def _existing(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


@dataclass(frozen=True)
class Sources:
    """Operational tables of one night; cancellations are already reflected in ``orders``."""

    orders: DataFrame
    items: DataFrame
    refunds: DataFrame
    order_promotions: DataFrame
    promotions: DataFrame


def refresh_customer_dim(dim: DataFrame, staging: DataFrame, as_of: date, path: str, order: list[str]) -> DataFrame:
    """Apply the night's changes, give new versions their keys and store the new dimension.

    Keys continue after the highest one without gaps: new rows are numbered by a
    distributed sort, so no task sees them all. The old dimension stays as it was.
    """
    changed = dimensions.apply_scd2_changes(dim, staging, as_of, order)
    stored = tables.write_new(changed, f"{path}/unkeyed")
    keyed = stored.filter(F.col("customer_key").isNotNull())
    fresh = folds.number_densely(stored.filter(F.col("customer_key").isNull()), ["customer_id", "effective_from"], "_number")
    highest = dim.agg(F.coalesce(F.max("customer_key"), F.lit(0)).alias("_top")).first()["_top"]
    numbered = fresh.withColumn(
        "customer_key", (F.col("_number") + highest + 1).cast(dim.schema["customer_key"].dataType)
    ).drop("_number")
    return tables.write_new(keyed.unionByName(numbered), f"{path}/dim")


def _loaded_ids(orders: DataFrame, stored: DataFrame | None) -> DataFrame | None:
    """Ids the fact holds in the months that ``orders`` reaches into; other months are not read."""
    if stored is None:
        return None
    # As many months as the night's orders have; a folder each.
    months = [r[0] for r in orders.select(F.date_format("order_date", "yyyy-MM")).distinct().collect() if r[0] is not None]
    return stored.filter(F.col(FACT_MONTH).cast("string").isin(months)).select("order_id")


def load_sales_fact(
    sources: Sources, customer_dim: DataFrame, time_dim: DataFrame, store_dim: DataFrame, fact_path: str
) -> DataFrame:
    """Append orders the fact does not hold yet, by month; running it again adds nothing."""
    spark = sources.orders.sparkSession
    fresh = facts.net_revenue_fact(
        sources.orders,
        sources.items,
        sources.refunds,
        sources.order_promotions,
        sources.promotions,
        customer_dim,
        time_dim,
        store_dim,
        _loaded_ids(sources.orders, _existing(spark, fact_path)),
    )
    fresh = facts.with_payment_time_key(fresh, time_dim).withColumn(FACT_MONTH, F.date_format("order_date", "yyyy-MM"))
    tables.append(fresh, fact_path, [FACT_MONTH])
    return tables.read_parquet(spark, fact_path, tables.schema_with_last(fresh, [FACT_MONTH]))


def repair_stored_fact(
    sources: Sources, changes: DataFrame, since: date, customer_dim: DataFrame, time_dim: DataFrame, store_dim: DataFrame, fact_path: str
) -> list[str]:
    """Make the fact rows of orders again that changed since a day, and replace the months they lie in; returns these months.

    ``changes`` logs orders that were cancelled, refunded or priced anew
    (order_id, order_date, changed_on). An order keeps its date, so its month is
    known without looking for it. Of the fact only these months are read: the
    join prunes the folders by the months of the changes as they turn out. Only
    their folders are replaced, each in one step after all its rows are written;
    a month that is left without rows loses its folder.
    """
    spark = changes.sparkSession
    recent = changes.filter(F.col("changed_on") >= F.lit(since)).select("order_id", F.date_format("order_date", "yyyy-MM").alias(FACT_MONTH)).distinct()
    stored = _existing(spark, fact_path)
    if stored is None:
        return []
    # Read with the schema the load writes: a folder name alone does not tell the type.
    stored = tables.read_parquet(spark, fact_path, T.StructType([f if f.name != FACT_MONTH else T.StructField(FACT_MONTH, T.StringType()) for f in stored.schema.fields]))
    kept = touched_months(stored, recent).join(recent.select("order_id"), "order_id", "left_anti")
    touched = cut_lineage(recent)
    inputs = facts.of_orders(touched, sources.orders, sources.items, sources.refunds, sources.order_promotions)
    again = facts.net_revenue_fact(*inputs, sources.promotions, customer_dim, time_dim, store_dim)
    again = facts.with_payment_time_key(again, time_dim).withColumn(FACT_MONTH, F.date_format("order_date", "yyyy-MM"))
    after = cut_lineage(kept.select(*stored.columns).unionByName(again.select(*stored.columns)))
    tables.replace_partitions(after, fact_path, [FACT_MONTH])
    months = lambda rows: {r[0] for r in rows.select(FACT_MONTH).distinct().collect()}
    wanted = months(touched)
    for month in wanted - months(after):
        remove_path(spark, f"{fact_path}/{FACT_MONTH}={month}")
    return sorted(wanted)


def touched_months(fact: DataFrame, changes: DataFrame) -> DataFrame:
    """Fact rows of the months that ``changes`` names."""
    return fact.join(changes.select(FACT_MONTH).distinct(), FACT_MONTH, "left_semi")


def nightly_sales(
    sources: Sources, changes: DataFrame, since: date, customer_dim: DataFrame, time_dim: DataFrame, store_dim: DataFrame, fact_path: str
) -> DataFrame:
    """Load new orders, repair changed ones, and return the verdicts of the cross-check."""
    load_sales_fact(sources, customer_dim, time_dim, store_dim, fact_path)
    repair_stored_fact(sources, changes, since, customer_dim, time_dim, store_dim, fact_path)
    return verify_load(tables.read_parquet(changes.sparkSession, fact_path), sources)


def record_snapshot(stock: DataFrame, at: datetime, path: str) -> DataFrame:
    """Store one of the day's stock snapshots; repeating the run for the same time replaces it."""
    spark = stock.sparkSession
    rows = inventory.capture_snapshot(stock, at).withColumn("slot", F.date_format("snapshot_time", "HHmm"))
    columns = ["snapshot_date", "slot"]
    tables.replace_partitions(rows, path, columns)
    return tables.read_parquet(spark, path, tables.schema_with_last(rows, columns))


def verify_load(fact: DataFrame, sources: Sources) -> DataFrame:
    """Orders and amounts per verdict of the cross-check against the source."""
    checked = facts.reconcile_fact(fact, sources.orders, sources.items)
    return checked.groupBy("verdict").agg(F.count("*").alias("orders"), F.sum("difference").alias("difference"))


def _counts() -> dict[str, dict[str, Column]]:
    return quality.scoreboard_counts(json_clean.WEIGHTLESS_TYPES)


def cleansed_products(products: DataFrame) -> DataFrame:
    """Weights of weightless products cleared, descriptions as JSON with their search key."""
    cleaned = json_clean.null_inapplicable(products, "weight_kg", "product_type")
    described = json_clean.text_to_json(cleaned, "description", "description_json")
    return serving.with_key_columns(described, ["raw_text"])


def remediate_products(products: DataFrame, root: str) -> tuple[DataFrame, dict[str, int]]:
    """The cleansed products, stored, and the figures that prove the clean-up."""
    return quality.write_counted(cleansed_products(products), f"{root}/products", _counts()["products"])


def remediate_customers(
    customers: DataFrame, orders: DataFrame, as_of: date, key: Column, root: str, vault: DataFrame | None = None
) -> tuple[dict[str, DataFrame], dict[str, int]]:
    """Card numbers vaulted, then purged; malformed profiles moved to the dead letters; and the figures that prove it.

    The vault is stored before the customers are rewritten without their numbers.
    """
    fresh = privacy.vault_pans(customers, orders, as_of, key)
    steps = {
        "vault": fresh if vault is None else privacy.upsert(vault, fresh, ["customer_id"]),
        "dead_letters": json_clean.dead_letters(customers, "customer_id", "profile_data", ["customer_id"]),
        "customers": json_clean.split_profiles(privacy.purge_pans(customers), "profile_data", "profile_data_json"),
    }
    stored, figures = {}, {}
    for name, rows in steps.items():
        stored[name], counted = quality.write_counted(rows, f"{root}/{name}", _counts()[name])
        figures |= counted
    return stored, figures


def remediate_plans(plans: DataFrame, customers: DataFrame, holding: Mapping, root: str) -> dict[str, DataFrame]:
    """Orphaned plans moved to a holding customer, which is added if need be."""
    owners = tables.write_new(quality.ensure_default_parent(customers, "customer_id", **holding), f"{root}/owners")
    fixed = quality.reparent_orphans(plans, owners, "customer_id", "customer_id")
    return {"owners": owners, "plans": tables.write_new(fixed, f"{root}/plans")}


def remediate_all(
    products: DataFrame, customers: DataFrame, plans: DataFrame, orders: DataFrame, *, as_of: datetime, key: Column, name: str, email: str, root: str
) -> dict[str, DataFrame]:
    """Products, customers and plans in turn, with the figures that prove the result, taken as the tables were written."""
    stored, figures = remediate_products(products, root)
    more, counted = remediate_customers(customers, orders, as_of.date(), key, root)
    done = {"products": stored, **more}
    holding = {"name": name, "email": email, "as_of": as_of}
    done |= remediate_plans(plans, done["customers"], holding, root)
    done["scoreboard"] = quality.as_items(products.sparkSession, figures | counted)
    done["broken_references"] = quality.fk_violations(done["plans"], done["owners"], "customer_id", "customer_id")
    return done
