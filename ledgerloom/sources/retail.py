"""Job inputs shaped from the generic test tables.

Each input is a list of (table, columns, condition) selects, joined by UNION
ALL. The expressions are plain SQL that Spark and the checking database read
alike, so both sides of a check start from the same rows.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession

CALENDAR_FIRST = date(1995, 1, 1)
CALENDAR_LAST = date(2001, 9, 30)
AS_OF = date(2001, 8, 1)
OUTBOX_AS_OF = datetime(2024, 1, 30, 0, 0, 0)


def money(column: str) -> str:
    return f"CAST({column} AS DECIMAL(18,2))"


def _text(column: str) -> str:
    return f"CAST({column} AS STRING)"


_ORDER_DAY = "CAST(o_orderdate AS DATE)"
_QTY = "CAST(l_quantity AS INT)"

_CUSTOMER_NAMES = {
    "customer_id": "c_custkey",
    "first_name": "c_name",
    "last_name": "c_mktsegment",
    "email": "lower(c_name) || '@example.com'",
}
_CITY = f"'NATION_' || {_text('c_nationkey')}"
_PROVINCE = f"'PROVINCE_' || {_text('c_nationkey % 5')}"


def _version(key: str, city: str, start: str, end: str, current: str) -> dict[str, str]:
    return {
        "customer_key": key,
        **_CUSTOMER_NAMES,
        "city": city,
        "province": _PROVINCE,
        "effective_from": f"DATE '{start}'",
        "effective_to": f"DATE '{end}'",
        "is_current": current,
    }


_OLD_VERSION = _version("c_custkey * 2", f"'OLD_' || {_text('c_nationkey')}", "1990-01-01", "1998-01-01", "false")
_NEW_VERSION = _version("c_custkey * 2 + 1", _CITY, "1998-01-01", "9999-12-31", "true")

_PROFILE = (
    "CASE c_custkey % 8 "
    "WHEN 0 THEN '{\"segment\":\"' || c_mktsegment || '\",\"tier\":' || CAST(c_nationkey AS STRING) || '}' "
    "WHEN 1 THEN '{\"segment\":\"' || c_mktsegment || '\"' "
    "WHEN 2 THEN '{\"segment\":\"' || c_mktsegment || '\"} trailing' "
    "WHEN 3 THEN NULL "
    "WHEN 4 THEN '[1,' || CAST(c_nationkey AS STRING) || ']' "
    "WHEN 5 THEN '' "
    "WHEN 6 THEN c_mktsegment "
    "ELSE CAST(c_nationkey AS STRING) END"
)

_PAN = (
    "CASE WHEN c_custkey % 4 = 0 THEN NULL "
    "WHEN c_custkey % 4 = 2 THEN lpad(CAST(c_custkey AS STRING), 15, '3') "
    "ELSE lpad(CAST(c_custkey AS STRING), 16, '4') END"
)

_DESCRIPTION = (
    "CASE p_partkey % 8 "
    "WHEN 0 THEN '{\"brand\":\"' || p_brand || '\",\"size\":' || CAST(p_size AS STRING) || '}' "
    "WHEN 1 THEN p_name "
    "WHEN 2 THEN '[\"' || p_brand || '\",' || CAST(p_size AS STRING) || ']' "
    "WHEN 3 THEN '{\"brand\":\"' || p_brand || '\"' "
    "WHEN 4 THEN '{\"brand\":\"' || p_brand || '\"} ' || p_name "
    "WHEN 5 THEN NULL "
    "WHEN 6 THEN '  {\"brand\":\"' || p_brand || '\"}' "
    "ELSE '' END"
)

_TV = '{"category":"television"'
_ATTRIBUTES = (
    "CASE p_partkey % 12 "
    f"WHEN 0 THEN '{_TV},\"screen_size\":' || CAST(p_size AS STRING) || '}}' "
    f"WHEN 1 THEN '{_TV},\"screen_size\":\"' || CAST(p_size AS STRING) || ' inches\"}}' "
    f"WHEN 2 THEN '{_TV},\"screen_size\":{{\"size\":' || CAST(p_size AS STRING) || '}}}}' "
    f"WHEN 3 THEN '{_TV},\"screen_size\":[' || CAST(p_size AS STRING) || ']}}' "
    f"WHEN 4 THEN '{_TV}}}' "
    f"WHEN 5 THEN '{{\"category\":\"television\",\"display_size\":\"' || CAST(p_size AS STRING) || ' in\"}}' "
    "WHEN 6 THEN '{\"capacity_liters\":' || CAST(p_size * 10 AS STRING) || ',\"category\":\"refrigerator\",\"energy_rating\":\"A\"}' "
    "WHEN 7 THEN '{\"capacity_liters\":\"' || CAST(p_size * 10 AS STRING) || ' l\",\"category\":\"refrigerator\"}' "
    "WHEN 8 THEN '{\"brand\":\"' || p_brand || '\"}' "
    f"WHEN 9 THEN '{_TV},\"screen_size\":null}}' "
    "WHEN 10 THEN '{\"category\":\"television\",\"resolution\":\"4k\",\"screen_size\":true,\"smart_tv\":true}' "
    f"ELSE '{_TV},\"screen_size\":\"1.2.3\"}}' END"
)

_STATUS = (
    "CASE WHEN o_orderstatus <> 'P' THEN 'completed' "
    "WHEN o_orderkey % 3 = 0 THEN 'cancelled' "
    "WHEN o_orderkey % 3 = 1 THEN 'cancelled_inventory' ELSE 'cancelled_fraud' END"
)
_CHANNEL = "CASE WHEN o_orderkey % 2 = 0 THEN 'online' ELSE 'retail' END"
_STORE = "CAST(o_custkey % 25 AS INT)"

_PRIORITY = (
    "CASE o_orderpriority WHEN '1-URGENT' THEN 'Critical' WHEN '2-HIGH' THEN 'High' "
    "WHEN '3-MEDIUM' THEN 'Medium' ELSE 'Low' END"
)

_RATING = "CAST(l_linenumber % 5 + 1 AS INT)"
_DELISTED = "l_partkey % 97 = 0"
# Late changes reach orders of a few months only.
_LATE = "(o_orderkey % 3 = 0 AND o_orderdate >= DATE '1997-03-01' AND o_orderdate < DATE '1997-07-01')"


def _awkward(key: str) -> str:
    """Endings with a tab, a backslash that looks like a null, a line end before a backslash, and other white space."""
    return (
        f"CASE {key} % 5 WHEN 0 THEN chr(9) || 'x' WHEN 1 THEN chr(92) || 'N' WHEN 2 THEN chr(10) || chr(92) || chr(92) || 't' "
        f"WHEN 3 THEN chr(13) || chr(11) || ' ' ELSE '' END"
    )


# name -> [(table, {column: expression}, condition or None), ...]
INPUTS: dict[str, list[tuple[str, dict[str, str], str | None]]] = {
    "pos_orders": [
        (
            "orders",
            {
                "order_id": "o_orderkey",
                "customer_id": "o_custkey",
                "order_date": "o_orderdate",
                "ship_date": f"{_ORDER_DAY} + CAST(o_orderkey % 9 AS INT)",
                "payment_received_date": f"{_ORDER_DAY} + CAST(o_orderkey % 120 AS INT)",
                "store_id": _STORE,
                "channel": _CHANNEL,
                "status": _STATUS,
                "total_amount": money("o_totalprice"),
            },
            None,
        )
    ],
    "items": [
        (
            "lineitem",
            {"order_id": "l_orderkey", "product_id": "l_partkey", "qty": _QTY, "unit_price": money("l_extendedprice")},
            None,
        )
    ],
    "refunds": [
        ("lineitem", {"order_id": "l_orderkey", "refund_amount": f"{money('l_extendedprice')} * {_QTY}"}, "l_returnflag = 'R'")
    ],
    "order_promotions": [
        ("lineitem", {"order_id": "l_orderkey", "promotion_id": "l_partkey"}, "l_returnflag <> 'R' AND l_discount > 0")
    ],
    "promotions": [("part", {"promotion_id": "p_partkey", "discount_amount": money("p_retailprice")}, None)],
    # Orders already in the warehouse before the load under test.
    "loaded_orders": [("orders", {"order_id": "o_orderkey"}, "o_orderdate < DATE '1996-01-01'")],
    # A fact as loaded before late cancellations and price corrections reached it.
    "stale_fact": [
        (
            "orders",
            {
                "order_id": "o_orderkey",
                "gross_revenue": f"CASE WHEN o_orderpriority = '1-URGENT' THEN {money('0')} ELSE {money('o_totalprice')} END",
            },
            "o_orderdate < DATE '2001-01-01'",
        )
    ],
    "stale_source_items": [
        ("orders", {"order_id": "o_orderkey", "qty": "1", "unit_price": money("o_totalprice")}, None),
    ],
    "customer_dim": [("customer", _OLD_VERSION, None), ("customer", _NEW_VERSION, None)],
    "type1_customer_dim": [
        ("customer", {"customer_key": "c_custkey", **_CUSTOMER_NAMES, "city": _CITY, "province": _PROVINCE}, None)
    ],
    "urgent_sales": [
        ("orders", {"customer_key": "o_custkey", "order_date": "o_orderdate"}, "o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    ],
    # A night's staging rows: moved, city lost, unchanged, a second later row for some, and new customers.
    "staging_customers": [
        (
            "customer",
            {
                **_CUSTOMER_NAMES,
                "city": f"CASE WHEN c_acctbal < 0 THEN 'MOVED' WHEN c_acctbal > 9000 THEN NULL ELSE {_CITY} END",
                "province": f"CASE WHEN c_mktsegment = 'MACHINERY' AND c_acctbal > 8000 THEN 'PROVINCE_9' ELSE {_PROVINCE} END",
                "loaded_at": "1",
            },
            None,
        ),
        (
            "customer",
            {**_CUSTOMER_NAMES, "city": "'MOVED_AGAIN'", "province": _PROVINCE, "loaded_at": "2"},
            "c_acctbal < -900 OR c_acctbal > 9900",
        ),
        (
            "supplier",
            {
                "customer_id": "s_suppkey + 1000000000000",
                "first_name": "s_name",
                "last_name": "'NEW'",
                "email": "lower(s_name) || '@example.com'",
                "city": f"'NATION_' || {_text('s_nationkey')}",
                "province": "'PROVINCE_NEW'",
                "loaded_at": "1",
            },
            None,
        ),
    ],
    "store_dim": [
        (
            "nation",
            {
                "store_key": "n_nationkey",
                "store_id": "n_nationkey",
                "store_name": "'Store ' || n_name",
                "manager_name": f"'Manager ' || {_text('n_nationkey')}",
            },
            None,
        )
    ],
    "pos_events": [
        (
            "events",
            {
                "order_id": "event_id",
                "customer_id": "user_id",
                "store_id": "CAST(user_id % 25 AS INT)",
                "order_date": "ts",
                "total_amount": money("value"),
                "channel": "CASE WHEN event_type = 'error' THEN 'online' ELSE 'retail' END",
            },
            None,
        )
    ],
    "product_dim": [
        (
            "part",
            {
                "product_key": "p_partkey * 10",
                "product_id": "p_partkey",
                "product_name": f"p_name || ' ' || {_text('p_partkey')}",
                "unit_cost": money("p_retailprice"),
            },
            None,
        )
    ],
    "inventory_snapshots": [
        (
            "events",
            {
                "product_id": "user_id",
                "store_id": "CAST(user_id % 25 AS INT)",
                "quantity_on_hand": "CAST(floor(value) AS INT)",
                "snapshot_time": "ts",
                "snapshot_date": "CAST(ts AS DATE)",
            },
            None,
        )
    ],
    # Sales at line grain, dated inside the month the snapshots cover.
    "line_fact": [
        (
            "lineitem",
            {
                "product_key": "l_partkey * 10",
                "order_date": "DATE '2024-01-01' + CAST(l_orderkey % 30 AS INT)",
                "net_revenue": money("l_extendedprice"),
            },
            None,
        )
    ],
    "current_inventory": [
        (
            "lineitem",
            {
                "store_id": "CAST(l_suppkey % 134 + 1 AS INT)",
                "product_id": "l_partkey",
                "quantity_available": _QTY,
            },
            None,
        )
    ],
    "plans": [
        (
            "orders",
            {
                "plan_id": "o_orderkey",
                "customer_id": "CASE WHEN o_orderkey % 50 = 0 THEN -5 - o_orderkey ELSE o_custkey END",
                "missed_payment_count": "CAST(o_orderkey % 7 AS INT)",
                "default_threshold": "3",
                "restructure_date": f"CASE WHEN o_orderkey % 5 = 0 THEN {_ORDER_DAY} + 30 END",
                "last_payment_date": f"{_ORDER_DAY} + CAST(o_orderkey % 90 AS INT)",
                "reversal_date": f"CASE WHEN o_orderkey % 13 = 0 THEN {_ORDER_DAY} + 60 END",
                "current_status": "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'active' "
                "WHEN 'P' THEN CASE WHEN o_orderpriority = '5-LOW' THEN 'legacy' ELSE 'frozen' END END",
            },
            None,
        )
    ],
    "customer_ids": [("customer", {"customer_id": "c_custkey"}, None)],
    "products": [
        (
            "part",
            {
                "product_id": "p_partkey",
                "product_type": "CASE p_type WHEN 'ECONOMY' THEN 'digital' WHEN 'PROMO' THEN 'financial' "
                "WHEN 'SMALL' THEN 'logistics' ELSE 'physical' END",
                "weight_kg": "p_size",
                "description": _DESCRIPTION,
            },
            None,
        )
    ],
    # Descriptions that nest: an object, an array of texts, a number, and a key with a quote in it.
    "nested_products": [
        (
            "part",
            {
                "product_id": "p_partkey",
                "description_json": "'{\"maker\":{\"name\":\"' || p_brand || '\"},\"tags\":[\"' || p_type || '\",\"all\"],\"size\":' || "
                f"{_text('p_size % 5')} || ',\"it' || chr(39) || 's\":true}}'",
            },
            None,
        )
    ],
    "enrichment": [("part", {"product_id": "p_partkey", "attributes": _ATTRIBUTES}, None)],
    "profiles": [("customer", {"customer_id": "c_custkey", "profile_data": _PROFILE}, None)],
    # The same customers written twice; the later write wins.
    "profile_writes": [
        ("customer", {"customer_id": "c_custkey", "profile_data": _PROFILE, "written": "1"}, None),
        (
            "customer",
            {"customer_id": "c_custkey", "profile_data": "'{\"balance\":' || CAST(c_custkey AS STRING)", "written": "2"},
            "c_acctbal < 0",
        ),
    ],
    "legacy_customers": [
        (
            "customer",
            {
                "customer_id": "c_custkey",
                "full_name": "c_name",
                "email": "lower(c_name) || '@example.com'",
                "phone": "'0300' || lpad(CAST(c_custkey AS STRING), 7, '0')",
                "card_last_sixteen": _PAN,
                "created_at": "DATE '2020-01-01'",
            },
            None,
        )
    ],
    "stored_vault": [
        (
            "customer",
            {"customer_id": "c_custkey", "retention_state": "'expired'", "captured_at": "DATE '2000-01-01'"},
            "c_acctbal > 5000",
        )
    ],
    "reviews": [("lineitem", {"product_id": "l_partkey", "rating": "CAST(l_linenumber % 5 + 1 AS INT)"}, None)],
    "outbox": [
        (
            "events",
            {
                "event_id": "event_id",
                "event_type": "event_type",
                "payload": "props",
                "processed": "event_id % 3 <> 0",
                "created_at": "ts",
            },
            None,
        )
    ],
    "query_log": [
        (
            "events",
            {
                "queryid": "user_id",
                "query": "'SELECT * FROM ' || event_type || ' WHERE payload = ' || lpad(CAST(user_id AS STRING), 90, '0')",
                "exec_ms": money("value"),
            },
            None,
        )
    ],
    "request_log": [
        ("events", {"name": "event_type", "ms": "CAST(floor(value * 12) AS DOUBLE) / 4", "failed": "event_id % 50 = 0"}, None)
    ],
    "register": [
        (
            "orders",
            {
                "problem_id": "o_orderkey",
                "problem_area": "'AREA_' || o_orderstatus",
                "problem_title": "'Order ' || CAST(o_orderkey AS STRING)",
                "priority": _PRIORITY,
                "status": "CASE WHEN o_totalprice > 250000 THEN 'Required' ELSE 'Identified' END",
            },
            None,
        )
    ],
    "decisions": [
        (
            "orders",
            {"problem_id": "o_orderkey", "chosen_option": "'Option ' || o_orderstatus", "trade_off": "o_orderpriority"},
            "o_totalprice > 100000",
        )
    ],
    "stock_requests": [
        (
            "lineitem",
            {
                "order_id": "l_orderkey",
                "line_no": "l_linenumber",
                "supplier_id": "l_suppkey",
                "price": money("l_extendedprice"),
                "store_id": "CAST(l_suppkey % 10 AS INT)",
                "product_id": "l_partkey",
                "qty": _QTY,
            },
            None,
        )
    ],
    # One request per order, with the order number as arrival number.
    "stream_requests": [
        (
            "orders",
            {
                "request_id": "o_orderkey",
                "store_id": "CAST(o_custkey % 10 AS INT)",
                "product_id": "o_custkey % 200",
                "qty": "CAST(o_orderkey % 17 + 1 AS BIGINT)",
            },
            None,
        )
    ],
    "shelf_keys": [("lineitem", {"store_id": "CAST(l_suppkey % 10 AS INT)", "product_id": "l_partkey"}, None)],
    "checkout_orders": [
        ("orders", {"order_id": "o_orderkey", "store_id": _STORE, "seq": "o_orderkey"}, None)
    ],
    "checkout_items": [("lineitem", {"order_id": "l_orderkey", "product_id": "l_partkey % 40", "qty": _QTY}, None)],
    "credit_accounts": [
        ("customer", {"customer_id": "c_custkey", "available_credit": money("c_acctbal"), "version": "CAST(1 AS BIGINT)"}, None)
    ],
    "credit_requests": [
        (
            "orders",
            {
                "request_id": "o_orderkey",
                "customer_id": "o_custkey",
                "expected_version": "CAST(o_orderkey % 4 + 1 AS BIGINT)",
                "amount": f"-{money('o_totalprice')}",
            },
            None,
        )
    ],
    "snapshot_before": [
        (
            "customer",
            {"customer_id": "c_custkey", "segment": "c_mktsegment", "balance": "CAST(floor(c_acctbal) AS BIGINT)", "city": _CITY},
            "c_acctbal < 9000",
        )
    ],
    "snapshot_after": [
        (
            "customer",
            {
                "customer_id": "c_custkey",
                "segment": "c_mktsegment",
                "balance": "CASE WHEN c_mktsegment = 'BUILDING' THEN CAST(floor(c_acctbal) AS BIGINT) + 7 "
                "WHEN c_mktsegment = 'FURNITURE' THEN NULL ELSE CAST(floor(c_acctbal) AS BIGINT) END",
                "city": _CITY,
            },
            "c_acctbal > -500",
        )
    ],
    "dated_orders": [
        (
            "orders",
            {
                "order_id": "o_orderkey",
                "customer_id": "o_custkey",
                "channel": _CHANNEL,
                "order_date": f"{_ORDER_DAY} + 9120",
                "total_amount": money("o_totalprice"),
            },
            None,
        )
    ],
    "store_orders": [
        (
            "lineitem",
            {
                "order_id": "l_orderkey",
                "customer_id": "l_linenumber",
                "product_id": "l_partkey",
                "store_id": "CAST(l_suppkey % 134 + 1 AS INT)",
            },
            None,
        )
    ],
    "customer_shard_am": [("customer", {"customer_id": "c_custkey", "last_name": "c_mktsegment", **{"city": _CITY}}, "c_mktsegment < 'N'")],
    "customer_shard_nz": [("supplier", {"customer_id": "s_suppkey", "last_name": "s_name", "city": f"'NATION_' || {_text('s_nationkey')}"}, None)],
    "product_changes": [
        (
            "events",
            {
                "change_id": "event_id",
                "product_id": "user_id",
                "op": "CASE event_type WHEN 'error' THEN 'd' WHEN 'signup' THEN 'c' ELSE 'u' END",
                "name": "event_type",
                "price": money("value"),
            },
            None,
        )
    ],
    # Reviews with the row before and after each change: re-rated, deleted, added, moved, withdrawn; some products lose all.
    "review_changes": [
        (
            "lineitem",
            {
                "change_id": "l_orderkey",
                "old_product_id": f"CASE WHEN l_orderkey % 10 <> 2 OR {_DELISTED} THEN l_partkey END",
                "old_rating": f"CASE WHEN l_orderkey % 10 <> 2 OR {_DELISTED} THEN {_RATING} END",
                "new_product_id": f"CASE WHEN {_DELISTED} OR l_orderkey % 10 = 1 THEN NULL WHEN l_orderkey % 10 = 2 THEN l_partkey + 1000000 "
                "WHEN l_orderkey % 10 = 3 THEN l_partkey % 50 + 1 ELSE l_partkey END",
                "new_rating": f"CASE WHEN l_orderkey % 10 = 4 THEN NULL WHEN l_orderkey % 10 = 2 THEN 3 WHEN l_orderkey % 10 = 3 THEN {_RATING} ELSE 6 - {_RATING} END",
            },
            f"l_orderkey % 10 < 5 OR {_DELISTED}",
        )
    ],
    "reviews_left": [
        (
            "lineitem",
            {"product_id": "l_partkey", "rating": _RATING},
            f"NOT (l_orderkey % 10 IN (0, 1, 3, 4) OR {_DELISTED})",
        )
    ],
    # Products as they are, next to a search copy that missed some changes.
    "live_products": [
        (
            "part",
            {
                "product_id": "p_partkey",
                "name": "CASE WHEN p_partkey % 83 = 0 THEN 'renamed' ELSE p_name END",
                "price": f"CASE WHEN p_partkey % 89 = 0 THEN NULL ELSE {money('p_retailprice')} END",
            },
            "p_partkey % 101 <> 0",
        ),
        ("part", {"product_id": "p_partkey + 1000000", "name": "p_name", "price": money("p_retailprice")}, "p_partkey % 103 = 0"),
    ],
    "asked_contacts": [
        ("orders", {"request_id": "o_orderkey", "customer_id": "CASE WHEN o_orderkey % 50 = 0 THEN -5 ELSE o_custkey END"}, "o_orderkey % 40 < 3")
    ],
    # Shards whose names hold what a dump has to escape.
    "dumped_am": [
        ("customer", {"customer_id": "c_custkey", "last_name": f"c_mktsegment || {_awkward('c_custkey')}", "city": f"CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE {_CITY} END"}, "c_mktsegment < 'N'")
    ],
    "dumped_nz": [
        ("supplier", {"customer_id": "s_suppkey", "last_name": f"CASE WHEN s_suppkey % 11 = 0 THEN '' ELSE s_name || {_awkward('s_suppkey')} END", "city": f"'NATION_' || {_text('s_nationkey')}"}, None)
    ],
    # Orders whose sagas hand events over, some of them twice.
    "saga_orders": [
        ("events", {"order_id": "event_id", "created_at": "ts", "position": "event_id"}, None),
        ("events", {"order_id": "event_id", "created_at": "ts", "position": "event_id + 1000000000"}, "event_id % 5 = 0"),
    ],
    # Orders cancelled or priced anew after the load of the day before.
    "order_changes": [
        ("orders", {"order_id": "o_orderkey", "order_date": "o_orderdate", "changed_on": f"CASE WHEN {_LATE} THEN DATE '2001-08-01' ELSE DATE '2001-07-01' END"}, "o_orderkey % 3 = 0")
    ],
    "search_copy": [
        ("part", {"product_id": "p_partkey", "name": "p_name", "price": money("p_retailprice")}, None)
    ],
    "benchmark_runs": [
        ("nation", {"run_id": "n_nationkey", "scenario_name": "'scenario ' || n_name"}, None)
    ],
    "benchmark_metrics": [
        (
            "events",
            {
                "run_id": "CAST(event_id % 20 AS INT)",
                "metric_name": "event_type",
                "metric_value": money("value"),
                "metric_unit": "'ms'",
            },
            None,
        )
    ],
}


class Tables:
    """The Parquet tables of one folder, each opened once."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.folder = sf_dir.rstrip("/")
        self._opened: dict[str, DataFrame] = {}

    def path(self, table: str) -> str:
        return f"{self.folder}/{table}.parquet"

    def open(self, table: str) -> DataFrame:
        if table not in self._opened:
            self._opened[table] = self.spark.read.parquet(self.path(table))
        return self._opened[table]

    def load(self, name: str) -> DataFrame:
        """A shaped input."""
        result = None
        for table, columns, condition in INPUTS[name]:
            rows = self.open(table)
            if condition:
                rows = rows.filter(condition)
            part = rows.selectExpr(*[f"{expression} AS {column}" for column, expression in columns.items()])
            result = part if result is None else result.unionByName(part)
        return result

    def follow(self, name: str) -> DataFrame:
        """A single-table input as a stream over the table's files."""
        ((table, columns, condition),) = INPUTS[name]
        # Written as a pattern, since a stream takes a folder or a pattern but no single file.
        pattern = f"{self.folder}/{{{table}}}.parquet"
        rows = self.spark.readStream.schema(self.open(table).schema).parquet(pattern)
        if condition:
            rows = rows.filter(condition)
        return rows.selectExpr(*[f"{expression} AS {column}" for column, expression in columns.items()])


def as_sql(name: str) -> str:
    """The same input as a SELECT over tables of the same names."""
    parts = []
    for table, columns, condition in INPUTS[name]:
        picked = ", ".join(f"{expression} AS {column}" for column, expression in columns.items())
        parts.append(f"SELECT {picked} FROM {table}" + (f" WHERE {condition}" if condition else ""))
    return " UNION ALL ".join(parts)
