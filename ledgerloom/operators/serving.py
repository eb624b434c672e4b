"""Queries behind the shop front and the operators' console."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import json_values as J
from ledgerloom.functions.scalars import guarded_ratio

# Page size, order threshold, report size and query stub length.
SEARCH_LIMIT = 50
FREQUENT_ORDERS = 5
SLOW_QUERIES = 20
STUB_LENGTH = 100


def product_ratings(reviews: DataFrame) -> DataFrame:
    """Average and number of ratings per product, to be stored and refreshed."""
    return reviews.groupBy("product_id").agg(
        guarded_ratio(F.sum("rating"), F.count("rating")).alias("avg_rating"), F.count("rating").alias("review_count")
    )


def contains(here: Column, wanted: object) -> Column:
    """JSON containment: the value ``here`` holds every key and value of ``wanted``.

    Objects nest; an array holds another when each wanted value occurs in it.
    Keys are looked up in a map, so they may hold quotes, dots and brackets.
    """
    if isinstance(wanted, Mapping):
        members = J.as_map(here)
        test = J.type_name(here) == "object"
        for name, value in wanted.items():
            test = test & contains(F.try_element_at(members, F.lit(name)), value)
        return F.coalesce(test, F.lit(False))
    if isinstance(wanted, (list, tuple)):
        items = F.try_variant_get(here, "$", "array<variant>")
        test = J.type_name(here) == "array"
        for value in wanted:
            test = test & F.exists(items, lambda item: contains(item, value))
        return F.coalesce(test, F.lit(False))
    if wanted is None:
        return F.coalesce(J.type_name(here) == "null", F.lit(False))
    if isinstance(wanted, bool):
        return F.coalesce((J.type_name(here) == "boolean") & (F.try_variant_get(here, "$", "boolean") == wanted), F.lit(False))
    if isinstance(wanted, (int, float)):
        return F.coalesce((J.type_name(here) == "number") & (F.try_variant_get(here, "$", "double") == float(wanted)), F.lit(False))
    return F.coalesce((J.type_name(here) == "string") & (F.try_variant_get(here, "$", "string") == str(wanted)), F.lit(False))


def with_key_columns(products: DataFrame, keys: list[str]) -> DataFrame:
    """Top-level text values of the description as columns, for storage next to it.

    They take the place of an index: Parquet keeps their range per row group, so
    an equality on them skips files and row groups before any JSON is parsed.
    """
    doc = F.try_parse_json("description_json")
    texts = {
        f"key_{key}": F.when(J.type_name(J.member(doc, key)) == "string", J.text_of(doc, key)) for key in keys
    }
    return products.withColumns(texts)


def product_search(products: DataFrame, ratings: DataFrame, wanted: Mapping, limit: int = SEARCH_LIMIT) -> DataFrame:
    """First products, by id, whose description contains ``wanted``, with their rating.

    Text keys stored by ``with_key_columns`` are compared as columns, which is
    all it takes when every wanted key is one. The page is cut before ratings are
    joined: a left join to one row per product changes no row count, so at most
    ``limit`` rows take part in it.
    """
    stored = {k: v for k, v in wanted.items() if isinstance(v, str) and f"key_{k}" in products.columns}
    rest = {k: v for k, v in wanted.items() if k not in stored}
    matching = products
    for key, value in stored.items():
        matching = matching.filter(F.col(f"key_{key}") == value)
    if rest or not stored:
        matching = matching.filter(contains(F.try_parse_json("description_json"), rest))
    page = matching.select("product_id", "description_json").orderBy("product_id").limit(limit)
    return page.join(ratings.select("product_id", "avg_rating"), "product_id", "left").select(
        "product_id", "description_json", "avg_rating"
    )


def order_tracking(orders: DataFrame, items: DataFrame, customer_id: int) -> DataFrame:
    mine = orders.filter(F.col("customer_id") == customer_id).select("order_id", "status")
    return mine.join(items, "order_id").select("order_id", "status", "product_id", "qty")


def order_lines_of(lines: DataFrame, customer_id: int) -> DataFrame:
    """The same from lines stored with their customer, bucketed by it: one bucket is read."""
    return lines.filter(F.col("customer_id") == customer_id).select("order_id", "status", "product_id", "qty")


def high_frequency_customers(orders: DataFrame, more_than: int = FREQUENT_ORDERS) -> DataFrame:
    counted = orders.groupBy("customer_id").agg(F.count("order_id").alias("order_count"))
    return counted.filter(F.col("order_count") > more_than)


_CONTACT_COLUMNS = ("customer_id", "full_name", "email", "phone")


def customer_by_id(customers: DataFrame, customer_id: int) -> DataFrame:
    """Contact row of one customer; the id is bound as a parameter, never spliced into SQL."""
    return customers.sparkSession.sql(
        f"SELECT {', '.join(_CONTACT_COLUMNS)} FROM {{customers}} WHERE customer_id = :id",
        args={"id": customer_id},
        customers=customers,
    )


def customer_by_email(customers: DataFrame, email: str) -> DataFrame:
    return customers.sparkSession.sql(
        f"SELECT {', '.join(_CONTACT_COLUMNS)} FROM {{customers}} WHERE email = :email",
        args={"email": email},
        customers=customers,
    )


def register_contact_function(customers: DataFrame, name: str = "customer_contact") -> str:
    """Make ``name(customer_id)`` a table function of the session: the contact row of one customer, none if there is none.

    It is a SQL function, so a call is expanded into the calling query: a
    constant reaches the scan as a filter, a column of a ``LATERAL`` join
    becomes an equality join.
    """
    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in customers.select(*_CONTACT_COLUMNS).schema.fields)
    kind, spark = customers.schema["customer_id"].dataType.simpleString(), customers.sparkSession
    customers.createOrReplaceTempView(f"{name}_rows")
    spark.sql(
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(wanted {kind}) RETURNS TABLE ({fields}) "
        f"RETURN SELECT {', '.join(_CONTACT_COLUMNS)} FROM {name}_rows WHERE customer_id = wanted"
    )
    return name


def contacts_of(requests: DataFrame, function: str, key: str = "customer_id") -> DataFrame:
    """Each request with the contact row of its customer; requests for unknown customers keep nulls."""
    columns = ", ".join(f"c.{name}" for name in _CONTACT_COLUMNS if name != key)
    return requests.sparkSession.sql(
        f"SELECT r.*, {columns} FROM {{requests}} r LEFT JOIN LATERAL {function}(r.{key}) c", requests=requests
    )


def order_inventory_join(orders: DataFrame, inventory: DataFrame, order_id: int | None = None) -> DataFrame:
    """Order lines with the quantity on hand in their store; optionally for one order."""
    if order_id is not None:
        orders = orders.filter(F.col("order_id") == order_id)
    stock = inventory.select("product_id", "store_id", "quantity_available")
    return orders.join(stock, ["product_id", "store_id"]).select("order_id", "customer_id", "product_id", "store_id", "quantity_available")


def top_slow_queries(log: DataFrame, limit: int = SLOW_QUERIES) -> DataFrame:
    """Query shapes by total time; ``log`` has one row per execution with its milliseconds."""
    total = F.col("_ms").cast("double")
    return (
        log.groupBy("queryid", F.left("query", F.lit(STUB_LENGTH)).alias("normalized_query_stub"))
        .agg(F.count("*").alias("calls"), F.sum("exec_ms").alias("_ms"))
        .orderBy(F.desc("_ms"), "queryid", "normalized_query_stub")
        .limit(limit)
        .select(
            "queryid",
            "normalized_query_stub",
            "calls",
            (total / 1000 / 60).alias("total_minutes_spent"),
            guarded_ratio(F.col("_ms"), F.col("calls")).alias("avg_ms_per_call"),
        )
    )
