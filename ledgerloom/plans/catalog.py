"""Every job as a named query over the tables of one folder."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import date, datetime, timedelta
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.functions import json_values as J
from ledgerloom.operators import (
    audit,
    credit,
    dimensions,
    facts,
    folds,
    inventory,
    json_clean,
    layout,
    monitoring,
    privacy,
    quality,
    reconcile,
    reports,
    serving,
    texts,
    visits,
)
from ledgerloom.operators import json_discovery as discovery
from ledgerloom.plans import jobs, store
from ledgerloom.session import scratch_path, tune
from ledgerloom.sources import dumps, retail, tables
from ledgerloom.streaming import changes, delivery, feeds, ledger, ratings
from ledgerloom.streaming import visits as live_visits

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SNAPSHOT_AT = datetime(2024, 2, 1, 10, 0, 0)
HOLDING = {"name": "Legal Holding (Orphans)", "email": "legal@example.com", "as_of": datetime(2001, 8, 1)}
PAN_EVENT = (
    # The event recorded when full card numbers were found.
    "PAN_CLASSIFICATION",
    "Full PAN records were found and tokenized/purged from operational customer table.",
    "Critical",
)
SHELF_STOCK = 60
CHECKOUT_STOCK = 500
REPORTED_RATE = Decimal("0.078")
PORTFOLIO = Decimal("18000000000")
TRACKED_CUSTOMER = 45
REPAIR_SINCE = date(2001, 7, 15)


class Inputs:
    """Access to the shaped inputs and the dimensions of one folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.tables = retail.Tables(spark, sf_dir)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in retail.INPUTS:
            raise AttributeError(name)
        return self.tables.load(name)

    @property
    def time_dim(self) -> DataFrame:
        return dimensions.calendar_dim(self.spark, retail.CALENDAR_FIRST, retail.CALENDAR_LAST)

    @property
    def sources(self) -> jobs.Sources:
        return jobs.Sources(self.pos_orders, self.items, self.refunds, self.order_promotions, self.promotions)

    def _kept(self, name: str, write: Callable[[str], T.StructType], *sources: str) -> DataFrame:
        return store.kept(self.spark, name, [self.tables.path(source) for source in sources], write)

    @property
    def net_fact(self) -> DataFrame:
        """The fact as the nightly job stores it, by month."""

        def write(path: str) -> T.StructType:
            return jobs.load_sales_fact(self.sources, self.customer_dim, self.time_dim, self.store_dim, path).schema

        return self._kept("sales-fact", write, "orders", "lineitem", "part", "customer", "nation")

    @property
    def stored_products(self) -> DataFrame:
        """The cleansed products as the clean-up pack stores them, with their search key."""
        return self._kept("products", lambda path: tables.write_new(jobs.cleansed_products(self.products), path).schema, "part")

    @property
    def stored_ratings(self) -> DataFrame:
        """The ratings view as its refresh stores it, with statistics."""

        def write(table: str, path: str) -> None:
            tables.store_view(serving.product_ratings(self.reviews), table)

        return store.kept_table(self.spark, "ratings", [self.tables.path("lineitem")], write)

    @property
    def order_lines(self) -> DataFrame:
        """Order lines with their order's customer and state, bucketed by customer."""

        def write(table: str, path: str) -> None:
            orders = self.pos_orders.select("order_id", "customer_id", "status")
            layout.write_bucketed(orders.join(self.items, "order_id"), table, path, "customer_id")

        return store.kept_table(self.spark, "order_lines", [self.tables.path(source) for source in ("orders", "lineitem")], write)

    @property
    def order_visits(self) -> DataFrame:
        return visits.retail_visits(self.pos_orders)

    @property
    def documents(self) -> DataFrame:
        return json_clean.with_document(self.enrichment, F.col("attributes"))

    @property
    def pan_key(self):
        # A fixed key for checks only; production passes one from its secret store.
        return F.unhex(F.md5(F.lit("check key")))


# Whole-number columns that may be null, given as double: tools disagree on how to show a missing integer.
SPARSE = {
    "scd2_apply_changes": ("customer_key",),
    "payment_time_key": ("payment_time_key",),
    "null_inapplicable_values": ("weight_kg",),
    "pan_classify": ("pan_length",),
    "pan_remediation_report": ("pan_length",),
    "credit_adjust_versioned": ("version_after",),
    "credit_adjust_stream": ("version_after",),
}


def plain(df: DataFrame, sparse: tuple[str, ...] = ()) -> DataFrame:
    """Comparable types: whole numbers as bigint, decimals as double, dates and times as text."""
    columns = []
    for field in df.schema.fields:
        kind, column = field.dataType, F.col(f"`{field.name}`")
        if field.name in sparse:
            column = column.cast("double")
        elif isinstance(kind, T.IntegralType):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.FractionalType)):
            column = column.cast("double")
        elif isinstance(kind, T.DateType):
            column = F.date_format(column, "yyyy-MM-dd")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, T.VariantType):
            column = F.to_json(column)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def query(function: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    """Register a job under its function name."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(function(Inputs(tune(spark), sf_dir)), SPARSE.get(function.__name__, ()))

    QUERIES[function.__name__] = run
    return function


# --- warehouse --------------------------------------------------------------


@query
def net_revenue_fact(t: Inputs) -> DataFrame:
    return facts.net_revenue_fact(
        t.pos_orders, t.items, t.refunds, t.order_promotions, t.promotions, t.customer_dim, t.time_dim, t.store_dim, t.loaded_orders
    )


@query
def fact_repair(t: Inputs) -> DataFrame:
    """A fact loaded before late cancellations and a price change, mended from the changed orders alone."""
    changed = F.col("order_id") % 7 == 0
    before = t.pos_orders.withColumn("status", F.when(changed, F.lit("completed")).otherwise(F.col("status")))
    old_prices = t.items.withColumn("unit_price", F.when(changed, F.lit(1)).otherwise(F.col("unit_price")).cast(t.items.schema["unit_price"].dataType))
    others = (t.refunds, t.order_promotions, t.promotions, t.customer_dim, t.time_dim, t.store_dim)
    stale = facts.net_revenue_fact(before, old_prices, *others)
    return facts.repair_fact(stale, t.pos_orders.filter(changed), t.pos_orders, t.items, *others)


@query
def fact_repair_stored(t: Inputs) -> DataFrame:
    """A fact stored before late cancellations and price changes: the nightly job mends its months, and the cross-check finds all matching."""
    late = t.order_changes.filter(F.col("changed_on") >= REPAIR_SINCE).select("order_id", F.lit(True).alias("late"))
    before = t.pos_orders.join(late, "order_id", "left").withColumn("status", F.when(F.col("late"), F.lit("completed")).otherwise(F.col("status")))
    price = F.when(F.col("late"), F.lit(1)).otherwise(F.col("unit_price")).cast(t.items.schema["unit_price"].dataType)
    old_prices = t.items.join(late, "order_id", "left").withColumn("unit_price", price)
    dims, path = (t.customer_dim, t.time_dim, t.store_dim), scratch_path(t.spark, "repaired-fact")
    jobs.load_sales_fact(replace(t.sources, orders=before.drop("late"), items=old_prices.drop("late")), *dims, path)
    return jobs.nightly_sales(t.sources, t.order_changes, REPAIR_SINCE, *dims, path)


@query
def gross_revenue_by_order(t: Inputs) -> DataFrame:
    return facts.gross_revenue_by_order(t.pos_orders, t.items)


@query
def refunds_by_order(t: Inputs) -> DataFrame:
    return facts.refunds_by_order(t.refunds)


@query
def discounts_by_order(t: Inputs) -> DataFrame:
    return facts.discounts_by_order(t.order_promotions, t.promotions)


def _versioned_orders(t: Inputs, **options) -> DataFrame:
    orders = t.pos_orders.select("order_id", "customer_id", "order_date")
    versions = t.customer_dim.select("customer_key", "customer_id", "city", "effective_from", "effective_to")
    return facts.as_of_version(orders, versions, "customer_id", "order_date", **options).select(
        "order_id", "customer_id", "customer_key", "city"
    )


@query
def scd2_as_of_join(t: Inputs) -> DataFrame:
    return _versioned_orders(t)


@query
def scd2_as_of_join_asis(t: Inputs) -> DataFrame:
    return _versioned_orders(t, inclusive_end=True)


@query
def incremental_new_orders(t: Inputs) -> DataFrame:
    return facts.not_yet_loaded(t.pos_orders.select("order_id", "customer_id", "status"), t.loaded_orders)


@query
def scd2_backfill(t: Inputs) -> DataFrame:
    return dimensions.backfill_validity(t.type1_customer_dim, t.urgent_sales).select(
        "customer_key", "customer_id", "city", "effective_from", "effective_to", "is_current"
    )


@query
def scd2_apply_changes(t: Inputs) -> DataFrame:
    return dimensions.apply_scd2_changes(t.customer_dim, t.staging_customers, retail.AS_OF, ["loaded_at"])


@query
def payment_time_key(t: Inputs) -> DataFrame:
    orders = t.pos_orders.select("order_id", "order_date", "payment_received_date")
    return facts.with_payment_time_key(orders, t.time_dim).select("order_id", "payment_received_date", "payment_time_key")


@query
def tax_revenue_by_quarter(t: Inputs) -> DataFrame:
    return facts.tax_revenue_by_quarter(t.net_fact, t.time_dim)


@query
def mgmt_revenue_by_quarter(t: Inputs) -> DataFrame:
    return facts.mgmt_revenue_by_quarter(t.net_fact, t.time_dim)


@query
def retail_visits(t: Inputs) -> DataFrame:
    return visits.retail_visits(t.pos_events)


@query
def corrected_basket_size(t: Inputs) -> DataFrame:
    return visits.corrected_basket_size(t.net_fact, t.order_visits, t.store_dim, t.time_dim)


@query
def corrected_basket_size_asis(t: Inputs) -> DataFrame:
    return visits.corrected_basket_size_asis(t.net_fact, t.order_visits, t.store_dim, t.time_dim)


def _reported_baskets(t: Inputs) -> DataFrame:
    """Commission reports on file: average order value per store and month, for half the year."""
    month = F.date_format("order_date", "MMMM")
    return (
        t.pos_orders.filter("channel = 'retail'")
        .groupBy("store_id", month.alias("month_name"))
        .agg((F.sum("total_amount").cast("double") / F.count("*")).alias("reported_basket_size"))
        .withColumn("commission_rate", (F.col("store_id") % 5 + 1).cast("double") / 100)
    )


@query
def commission_backpay(t: Inputs) -> DataFrame:
    return visits.commission_backpay(t.net_fact, t.order_visits, t.store_dim, t.time_dim, _reported_baskets(t))


@query
def commission_backpay_asis(t: Inputs) -> DataFrame:
    return visits.commission_backpay_asis(t.net_fact, t.order_visits, t.store_dim, t.time_dim, _reported_baskets(t))


@query
def inventory_snapshot_capture(t: Inputs) -> DataFrame:
    return inventory.capture_snapshot(t.current_inventory, SNAPSHOT_AT)


SNAPSHOT_HOURS = (0, 6, 30)


@query
def inventory_snapshot_history(t: Inputs) -> DataFrame:
    """Snapshots of two days, several a day, appended one after the other and read back."""
    path = scratch_path(t.spark, "snapshots")
    for hours in SNAPSHOT_HOURS:
        tables.append(inventory.capture_snapshot(t.current_inventory, SNAPSHOT_AT + timedelta(hours=hours)), path, ["snapshot_date"])
    stored = tables.read_parquet(t.spark, path)
    return stored.groupBy("snapshot_date", "snapshot_time", "store_id").agg(F.count("*").alias("products"), F.sum("quantity_on_hand").alias("units"))


@query
def inventory_turnover(t: Inputs) -> DataFrame:
    return inventory.inventory_turnover(t.line_fact, t.product_dim, t.inventory_snapshots)


@query
def inventory_turnover_asis(t: Inputs) -> DataFrame:
    return inventory.inventory_turnover_asis(t.line_fact, t.product_dim, t.inventory_snapshots)


def _plans(t: Inputs) -> DataFrame:
    return credit.reclassify_plans(t.plans, t.customer_ids, retail.AS_OF)


def _default_rate(t: Inputs) -> DataFrame:
    return credit.plan_default_rate(_plans(t), credit.plan_status_dim(t.spark))


@query
def plan_status_reclassify(t: Inputs) -> DataFrame:
    return _plans(t).select("plan_id", "customer_id", "status_category")


@query
def plan_default_rate(t: Inputs) -> DataFrame:
    return _default_rate(t)


@query
def reserve_overstatement(t: Inputs) -> DataFrame:
    return credit.reserve_overstatement(_default_rate(t), REPORTED_RATE, PORTFOLIO)


@query
def fact_source_reconcile(t: Inputs) -> DataFrame:
    return facts.reconcile_fact(t.stale_fact, t.pos_orders, t.stale_source_items)


# --- cleansing and quality --------------------------------------------------


@query
def null_inapplicable_values(t: Inputs) -> DataFrame:
    return json_clean.null_inapplicable(t.products, "weight_kg", "product_type").select("product_id", "product_type", "weight_kg")


@query
def text_to_json_or_wrap(t: Inputs) -> DataFrame:
    return json_clean.text_to_json(t.products, "description", "description_json").select("product_id", "description_json")


@query
def json_profile_split(t: Inputs) -> DataFrame:
    return json_clean.split_profiles(t.profiles, "profile_data", "profile_data_json")


@query
def json_dead_letter(t: Inputs) -> DataFrame:
    return json_clean.dead_letters(t.profile_writes, "customer_id", "profile_data", ["written"])


@query
def json_attribute_profile(t: Inputs) -> DataFrame:
    documents = t.documents
    parts = [
        json_clean.attribute_profile(documents, "doc", key).select(F.lit(key).alias("attribute"), "*")
        for key in ("screen_size", "display_size")
    ]
    return parts[0].unionByName(parts[1])


@query
def json_discovery(t: Inputs) -> DataFrame:
    """Every path of the product documents with its types, from one scan."""
    found = discovery.json_paths(t.documents, "doc")
    return found.select("path", "json_type", "sample_value", "occurrences", (F.col("merged_schema") == "VARIANT").alias("mixed_types"))


@query
def json_normalize_numeric(t: Inputs) -> DataFrame:
    return json_clean.normalize_numeric(t.documents, "doc", "screen_size").select("product_id", F.col("doc").alias("attributes"))


@query
def json_alias_merge(t: Inputs) -> DataFrame:
    merged = json_clean.merge_alias(t.documents, "doc", "display_size", "screen_size")
    return json_clean.normalize_numeric(merged, "doc", "screen_size").select("product_id", F.col("doc").alias("attributes"))


@query
def json_contract_check(t: Inputs) -> DataFrame:
    return json_clean.contract_check(t.documents, "product_id", "doc")


@query
def json_schema_validate(t: Inputs) -> DataFrame:
    return json_clean.schema_violations(t.documents, "product_id", "doc", json_clean.contract_table(t.spark))


@query
def constraint_report(t: Inputs) -> DataFrame:
    orders = t.pos_orders
    rules = {
        "channel_known": F.col("channel").isin("online", "retail"),
        "status_known": F.col("status").isin("completed", "cancelled", "cancelled_fraud"),
        "total_not_negative": F.col("total_amount") >= 0,
        "total_below_limit": F.col("total_amount") < 400000,
        "customer_present": F.col("customer_id").isNotNull(),
        "shipped_before_paid": F.col("ship_date") <= F.col("payment_received_date"),
    }
    unique = quality.duplicate_keys(t.items, ["order_id", "product_id"], "order_product_unique")
    return quality.constraint_report(orders, rules).unionByName(unique)


@query
def fk_violations(t: Inputs) -> DataFrame:
    return quality.fk_violations(t.plans, t.customer_ids, "customer_id", "customer_id").select("plan_id", "customer_id")


@query
def orphan_reparent(t: Inputs) -> DataFrame:
    return quality.reparent_orphans(t.plans, t.customer_ids, "customer_id", "customer_id").select("plan_id", "customer_id")


@query
def ensure_default_parent(t: Inputs) -> DataFrame:
    return quality.ensure_default_parent(t.legacy_customers, "customer_id", **HOLDING)


@query
def remediation_scoreboard(t: Inputs) -> DataFrame:
    products = json_clean.text_to_json(t.products, "description", "description_json")
    cleaned = json_clean.null_inapplicable(products, "weight_kg", "product_type")
    profiles = json_clean.split_profiles(t.profiles, "profile_data", "profile_data_json")
    customers = privacy.purge_pans(t.legacy_customers).join(profiles, "customer_id")
    vault = privacy.vault_pans(t.legacy_customers, t.pos_orders, retail.AS_OF, t.pan_key)
    letters = json_clean.dead_letters(t.profile_writes, "customer_id", "profile_data", ["written"])
    return quality.remediation_scoreboard(cleaned, customers, vault, letters, json_clean.WEIGHTLESS_TYPES)


@query
def remediation_scoreboard_observed(t: Inputs) -> DataFrame:
    """The same figures, taken while the clean-up pack writes its tables."""
    profiles = t.profiles.withColumnRenamed("customer_id", "profile_of")
    customers = t.legacy_customers.join(profiles, F.col("customer_id") == F.col("profile_of")).drop("profile_of")
    root, counts = scratch_path(t.spark, "counted"), quality.scoreboard_counts(json_clean.WEIGHTLESS_TYPES)
    products, figures = jobs.remediate_products(t.products, root)
    cleaned = json_clean.split_profiles(privacy.purge_pans(customers), "profile_data", "profile_data_json")
    steps = {
        "customers": cleaned,
        "vault": privacy.vault_pans(t.legacy_customers, t.pos_orders, retail.AS_OF, t.pan_key),
        "dead_letters": json_clean.dead_letters(t.profile_writes, "customer_id", "profile_data", ["written"]),
    }
    for name, rows in steps.items():
        figures |= quality.write_counted(rows, f"{root}/{name}", counts[name])[1]
    return quality.as_items(t.spark, figures)


@query
def broken_rules_by_product(t: Inputs) -> DataFrame:
    """The contract rules each product breaks, as one text in their order."""
    broken = json_clean.schema_violations(t.documents, "product_id", "doc", json_clean.contract_table(t.spark))
    rules = broken.select("product_id", F.concat_ws(" ", "field", "problem").alias("rules"))
    return texts.ordered_list(rules, ["product_id"], "rules", ", ")


@query
def shard_dump_load(t: Inputs) -> DataFrame:
    """Two shards dumped as tab-separated text, loaded again and merged; ids that more than one row claims are counted."""
    shards = []
    for name in ("dumped_am", "dumped_nz"):
        rows, path = getattr(t, name), scratch_path(t.spark, name)
        dumps.write_dump(rows, path, "public.customers")
        shards.append(dumps.read_dump(t.spark, path, rows.schema)[0])
    merged, clashes = quality.consolidate_shards(shards, "customer_id")
    return merged.join(clashes, "customer_id", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))


@query
def shard_consolidate(t: Inputs) -> DataFrame:
    merged, clashes = quality.consolidate_shards([t.customer_shard_am, t.customer_shard_nz], "customer_id")
    return merged.join(clashes, "customer_id", "left").withColumn("copies", F.coalesce("copies", F.lit(1)))


# --- privacy and audit ------------------------------------------------------


@query
def pan_classify(t: Inputs) -> DataFrame:
    return privacy.classify_pans(t.legacy_customers)


@query
def pan_tokenize(t: Inputs) -> DataFrame:
    return privacy.tokenize_pans(t.legacy_customers)


@query
def pan_purge(t: Inputs) -> DataFrame:
    return privacy.purge_pans(t.legacy_customers).select("customer_id", "full_name", "card_last_sixteen")


@query
def pan_vault_upsert(t: Inputs) -> DataFrame:
    """Ciphertext differs from run to run, so the check decrypts it again."""
    key = t.pan_key
    fresh = privacy.vault_pans(t.legacy_customers, t.pos_orders, retail.AS_OF, key)
    stored = t.stored_vault.withColumn("pan_ciphertext", F.aes_encrypt(F.lit("held before"), key))
    vault = privacy.upsert(stored, fresh, ["customer_id"])
    return vault.select(
        "customer_id",
        "retention_state",
        "captured_at",
        F.aes_decrypt("pan_ciphertext", key).cast("string").alias("pan_after_decrypt"),
    )


@query
def pan_remediation_report(t: Inputs) -> DataFrame:
    return privacy.remediation_report(privacy.classify_pans(t.legacy_customers), privacy.tokenize_pans(t.legacy_customers))


@query
def masked_customer_view(t: Inputs) -> DataFrame:
    return privacy.support_view(t.legacy_customers)


@query
def audit_change_log(t: Inputs) -> DataFrame:
    return audit.change_log(t.snapshot_before, t.snapshot_after, "customer_id", "customers")


@query
def suspicious_event_if_exists(t: Inputs) -> DataFrame:
    found = privacy.classify_pans(t.legacy_customers).filter("classification_status = 'FULL_PAN_FOUND'")
    return audit.event_if_any(found, *PAN_EVENT)


# --- serving and stateful updates -------------------------------------------


@query
def product_ratings(t: Inputs) -> DataFrame:
    return serving.product_ratings(t.reviews)


NESTED = {"maker": {"name": "Brand#8"}, "tags": ["all"], "size": 2, "it's": True}


@query
def product_search_nested(t: Inputs) -> DataFrame:
    """Containment of an object, an array, a number and a boolean in the JSON itself."""
    return serving.product_search(t.nested_products, t.stored_ratings, NESTED)


@query
def product_search(t: Inputs) -> DataFrame:
    """Search reads the cleansed table and the ratings view as stored, with the search key next to the JSON."""
    return serving.product_search(t.stored_products, t.stored_ratings, {"raw_text": "red widget"})


@query
def order_tracking(t: Inputs) -> DataFrame:
    """One customer's lines from the one bucket that can hold them."""
    return serving.order_lines_of(t.order_lines, TRACKED_CUSTOMER)


@query
def product_ratings_incremental(t: Inputs) -> DataFrame:
    """The stored view after three batches of changed reviews, never recomputed from all."""
    path, product = scratch_path(t.spark, "ratings-view"), t.reviews.schema["product_id"].dataType
    ratings.build(t.reviews, path)
    stream = _ordered_feed(t, t.review_changes, "review-changes", "change_id")
    feeds.drain(stream, ratings.maintain(path, product), feeds.new_checkpoint(t.spark, "review-changes"))
    return ratings.ratings(t.spark, path, product)


@query
def search_copy_reconcile(t: Inputs) -> DataFrame:
    """Products the search copy lacks, holds in an older state, or has too many; only unequal leaves are read."""
    live, copy = scratch_path(t.spark, "live-products"), scratch_path(t.spark, "search-copy")
    reconcile.store(t.live_products, "product_id", live)
    reconcile.store(t.search_copy, "product_id", copy)
    return reconcile.reconcile(t.spark, live, copy, t.search_copy.schema, "product_id")


@query
def customer_contacts_lateral(t: Inputs) -> DataFrame:
    """A list of requests joined to the contact function."""
    return serving.contacts_of(t.asked_contacts, serving.register_contact_function(t.legacy_customers))


@query
def high_frequency_customers(t: Inputs) -> DataFrame:
    return serving.high_frequency_customers(t.pos_orders)


@query
def customer_by_id(t: Inputs) -> DataFrame:
    return serving.customer_by_id(t.legacy_customers, TRACKED_CUSTOMER)


@query
def customer_by_email(t: Inputs) -> DataFrame:
    return serving.customer_by_email(t.legacy_customers, "customer#000000007@example.com")


@query
def order_inventory_join(t: Inputs) -> DataFrame:
    stock = t.current_inventory.groupBy("product_id", "store_id").agg(F.sum("quantity_available").alias("quantity_available"))
    return serving.order_inventory_join(t.store_orders, stock)


@query
def top_slow_queries(t: Inputs) -> DataFrame:
    return serving.top_slow_queries(t.query_log)


@query
def stock_reserve(t: Inputs) -> DataFrame:
    shelf = t.shelf_keys.distinct().withColumn("stock", F.lit(SHELF_STOCK))
    return folds.reserve_stock(t.stock_requests, shelf, ["order_id", "line_no", "supplier_id", "price"])


@query
def place_orders_atomic(t: Inputs) -> DataFrame:
    shelf = (
        t.checkout_items.join(t.checkout_orders, "order_id")
        .select("store_id", "product_id")
        .distinct()
        .withColumn("stock", F.lit(CHECKOUT_STOCK))
    )
    return folds.place_orders(t.checkout_orders, t.checkout_items, shelf)


@query
def credit_adjust_versioned(t: Inputs) -> DataFrame:
    return folds.adjust_credit(t.credit_requests, t.credit_accounts, ["request_id"])


# --- layouts ----------------------------------------------------------------


@query
def list_partition_read(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "inventory")
    stored = layout.write_by_list(t.current_inventory, path, "store_id")
    return stored.groupBy("store_id").agg(F.count("*").alias("items"), F.sum("quantity_available").alias("stock"))


ONE_STORE = 7


@query
def list_partition_one_store(t: Inputs) -> DataFrame:
    """Only the folder of the store is scanned."""
    stored = layout.write_by_list(t.current_inventory, scratch_path(t.spark, "inventory"), "store_id")
    return layout.read_one(stored, "store_id", ONE_STORE).select("product_id", "store_id", "quantity_available")


@query
def month_partition_read(t: Inputs) -> DataFrame:
    path = scratch_path(t.spark, "orders")
    stored = layout.write_by_month(t.dated_orders, path, "order_date")
    return stored.groupBy("order_month").agg(F.count("*").alias("orders"), F.sum("total_amount").alias("amount"))


@query
def hash_partition_counts(t: Inputs) -> DataFrame:
    return layout.hash_partition_counts(t.legacy_customers, "customer_id")


@query
def partition_backfill(t: Inputs) -> DataFrame:
    legacy = t.current_inventory
    empty = t.spark.createDataFrame([], legacy.schema)
    stored = layout.backfill_if_empty(empty, legacy, scratch_path(t.spark, "backfill"), "store_id")
    # The second run finds rows and copies nothing.
    again = layout.backfill_if_empty(stored, legacy, scratch_path(t.spark, "backfill"), "store_id")
    return again.groupBy("product_id").agg(F.count("*").alias("rows"), F.sum("quantity_available").alias("stock"))


# --- reports and monitoring -------------------------------------------------

REGISTER_COLUMNS = ("problem_id", "problem_area", "problem_title", "priority")


@query
def critical_issue_report(t: Inputs) -> DataFrame:
    return reports.issue_report(t.register, REGISTER_COLUMNS, "Critical")


@query
def issue_summary_report(t: Inputs) -> DataFrame:
    return reports.issue_report(t.register, REGISTER_COLUMNS)


@query
def priority_summary(t: Inputs) -> DataFrame:
    return reports.priority_summary(t.register)


@query
def area_summary(t: Inputs) -> DataFrame:
    return reports.area_summary(t.register)


@query
def register_with_decisions(t: Inputs) -> DataFrame:
    return reports.register_with_decisions(t.register, t.decisions, ("chosen_option", "trade_off"))


@query
def ranked_register_report(t: Inputs) -> DataFrame:
    return reports.ranked_register(t.register, REGISTER_COLUMNS)


@query
def kpi_scoreboard(t: Inputs) -> DataFrame:
    register = {
        "Total Problems Identified": "true",
        "Critical Problems": "priority = 'Critical'",
        "High Problems": "priority = 'High'",
        "Required Controls": "status = 'Required'",
    }
    tokens = privacy.tokenize_pans(t.legacy_customers)
    log = audit.change_log(t.snapshot_before, t.snapshot_after, "customer_id", "customers")
    return reports.kpi_scoreboard(  # fixed values: the names and the recommendation as the report words them
        [(t.register, register), (tokens, {"PAN Records Tokenized": "true"}), (log, {"Audit Records Generated": "true"})],
        {"Main Recommendation": "Fix security and recovery first"},
    )


@query
def derive_log_rows(t: Inputs) -> DataFrame:
    return reports.derive_log_rows(
        t.register, "problem_id", {"control_area": "Governance", "control_name": "Decision Log"}
    )


@query
def outbox_pending(t: Inputs) -> DataFrame:
    return monitoring.pending_events(t.outbox).select("event_id", "event_type", "payload", "created_at")


@query
def outbox_lag_alert(t: Inputs) -> DataFrame:
    return monitoring.outbox_lag(t.outbox, retail.OUTBOX_AS_OF)


@query
def latency_sla_report(t: Inputs) -> DataFrame:
    return _rounded(monitoring.latency_report(t.request_log))


def _rounded(report: DataFrame) -> DataFrame:
    """Interpolated percentiles to six decimals: engines differ in the last bit."""
    return report.withColumns({name: F.round(name, 6) for name in ("median_ms", "p99_ms")})


@query
def latency_sla_report_csv(t: Inputs) -> DataFrame:
    """The report from the load tester's statistics file, here written from the request log.

    One name has a percentile that is no number, and the file ends with the sum row.
    """
    measured = monitoring.latency_report(t.request_log)
    p99 = F.when(F.col("name") == "error", F.lit("N/A")).otherwise(F.col("p99_ms").cast("string"))
    names = tables.LOAD_STATS_COLUMNS
    rows = measured.select(*[c.alias(n) for c, n in zip((F.col("name"), F.col("total_calls"), F.col("failures"), F.col("median_ms"), p99), names)])
    totals = measured.select(F.lit(monitoring.TOTALS_ROW), F.sum("total_calls"), F.sum("failures"), F.lit(0.0), F.lit("0")).toDF(*names)
    path = scratch_path(t.spark, "load-stats")
    rows.unionByName(totals).write.csv(path, header=True)
    return _rounded(monitoring.latency_report_from_stats(tables.read_load_stats(t.spark, path)))


@query
def benchmark_metric_store(t: Inputs) -> DataFrame:
    """Both tables are appended to storage and read back before they are joined."""
    runs_path, metrics_path = scratch_path(t.spark, "runs"), scratch_path(t.spark, "metrics")
    runs, metrics = t.benchmark_runs, t.benchmark_metrics
    tables.append(runs, runs_path)
    tables.append(metrics, metrics_path)
    return monitoring.metrics_by_run(
        tables.read_parquet(t.spark, runs_path, runs.schema), tables.read_parquet(t.spark, metrics_path, metrics.schema)
    )


# --- feeds -------------------------------------------------------------------

VISIT_LATENESS = "30 minutes"


def _landed_feed(t: Inputs, rows: DataFrame, label: str, batches: int = 1) -> DataFrame:
    """An input landed as files and followed in ``batches`` micro-batches.

    Only feeds whose result does not depend on which file comes first use more
    than one.
    """
    path = scratch_path(t.spark, label)
    if batches == 1:
        rows.write.parquet(path)
        return feeds.follow_parquet(t.spark, path, rows.schema)
    files = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    rows.repartition(files).write.parquet(path)
    return feeds.follow_parquet(t.spark, path, rows.schema, max_files=-(-files // batches))


def _ordered_feed(t: Inputs, rows: DataFrame, label: str, order: str, batches: int = 3) -> DataFrame:
    """An input landed in slices of its order, each stored after the one before and followed as one micro-batch."""
    path, files = scratch_path(t.spark, label), 2
    cuts = [None, *rows.approxQuantile(order, [n / batches for n in range(1, batches)], 0.001), None]
    for low, high in zip(cuts, cuts[1:]):
        part = rows if low is None else rows.filter(F.col(order) >= low)
        part = part if high is None else part.filter(F.col(order) < high)
        part.repartition(files).write.mode("append").parquet(path)
    return feeds.follow_parquet(t.spark, path, rows.schema, max_files=files)


@query
def retail_visits_stream(t: Inputs) -> DataFrame:
    """All visits: those the watermark closes, then those still open when the feed has ended."""
    stream, markers = t.tables.follow("pos_events"), scratch_path(t.spark, "end-of-feed")
    path, checkpoint = scratch_path(t.spark, "visits"), feeds.new_checkpoint(t.spark, "visits")
    visits_out = live_visits.visit_stream(live_visits.with_end_of_feed(stream, markers), VISIT_LATENESS)
    feeds.drain_to_files(visits_out, path, checkpoint)
    live_visits.close_feed(t.spark, stream.schema, markers)
    return feeds.drain_to_files(visits_out, path, checkpoint)


@query
def cdc_upsert_sync(t: Inputs) -> DataFrame:
    stream = _landed_feed(t, t.product_changes, "product-changes", batches=3)
    path = scratch_path(t.spark, "product-sync")
    feeds.drain(stream, changes.record_changes(path, "product_id", ["change_id"]), feeds.new_checkpoint(t.spark, "product-sync"))
    stored = changes.read_changes(t.search_copy, path, stream.schema)
    return changes.current_copy(t.search_copy, stored, "product_id", ["change_id"])


@query
def audit_change_stream(t: Inputs) -> DataFrame:
    """Three micro-batches; the log has one row per change that changes something."""
    stream = _ordered_feed(t, t.product_changes, "audited-changes", "change_id")
    changes_path, audit_path = scratch_path(t.spark, "audited"), scratch_path(t.spark, "audit-log")
    handler = changes.record_audit(
        t.search_copy, changes_path, audit_path, "product_id", ["change_id"], "products", stream.schema
    )
    feeds.drain(stream, handler, feeds.new_checkpoint(t.spark, "audit"))
    return t.spark.read.parquet(audit_path).drop(changes.BATCH)


@query
def outbox_delivery(t: Inputs) -> DataFrame:
    """Events of order sagas, handed over in three batches and some of them twice, delivered once."""
    stream = _ordered_feed(t, delivery.saga_events(t.saga_orders, "position"), "saga-events", "position").drop("position")
    path = scratch_path(t.spark, "delivered")
    feeds.drain(stream, delivery.deliver_once(path), feeds.new_checkpoint(t.spark, "delivered"))
    return delivery.delivered(t.spark, path, stream.schema).select(*stream.columns)


@query
def outbox_lag_stream(t: Inputs) -> DataFrame:
    """Backlog after the last micro-batch."""
    events = t.outbox.select("event_id", "created_at", "processed")
    stream = _landed_feed(t, events, "outbox", batches=3)
    pending, alerts = scratch_path(t.spark, "outbox-pending"), scratch_path(t.spark, "outbox-alerts")
    handler = changes.watch_outbox(pending, alerts, lambda _: retail.OUTBOX_AS_OF, events.schema)
    feeds.drain(stream, handler, feeds.new_checkpoint(t.spark, "outbox"))
    logged = t.spark.read.parquet(alerts)
    return logged.groupBy().agg(F.max_by("lag", changes.BATCH).alias("lag"), F.max_by("alert", changes.BATCH).alias("alert"))


@query
def stock_reserve_stream(t: Inputs) -> DataFrame:
    """Three micro-batches in arrival order; the stock left is keyed state."""
    requests = t.stream_requests
    stream = _ordered_feed(t, requests, "stock-requests", "request_id")
    shelf = requests.select("store_id", "product_id").distinct().withColumn("stock", F.lit(SHELF_STOCK))
    return feeds.drain_to_files(
        ledger.reservations(stream, shelf, ["request_id"]), scratch_path(t.spark, "reserved"), feeds.new_checkpoint(t.spark, "reserved")
    )


@query
def credit_adjust_stream(t: Inputs) -> DataFrame:
    """Three micro-batches in arrival order; credit and version are keyed state."""
    stream = _ordered_feed(t, t.credit_requests, "credit-requests", "request_id")
    return feeds.drain_to_files(
        ledger.credit_changes(stream, t.credit_accounts, ["request_id"]), scratch_path(t.spark, "credit"), feeds.new_checkpoint(t.spark, "credit")
    )
