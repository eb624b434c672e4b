"""SQL that computes the same answers on the same tables, for checking.

Written against the tables directly and in the plain form of each question
(row-level joins, windows over raw rows, recursion for ordered updates), so it
does not repeat how the jobs are built.
"""

from __future__ import annotations

from ledgerloom.plans import catalog
from ledgerloom.sources import retail
from ledgerloom.streaming import delivery

_TIME_DIM = (
    "SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS time_key, CAST(d AS DATE) AS full_date, monthname(d) AS month_name, "
    "quarter(d) AS fiscal_quarter, year(d) AS fiscal_year "
    f"FROM generate_series(DATE '{retail.CALENDAR_FIRST}', DATE '{retail.CALENDAR_LAST}', INTERVAL 1 DAY) AS s(d)"
)

_GROSS = (
    "SELECT o.order_id, o.customer_id, o.order_date, o.ship_date, o.payment_received_date, o.store_id, o.channel, "
    "sum(i.unit_price * i.qty) AS gross_amount FROM pos_orders o JOIN items i ON o.order_id = i.order_id "
    "WHERE o.status NOT IN ('cancelled', 'cancelled_inventory', 'cancelled_fraud') GROUP BY ALL"
)
_REFUNDED = "SELECT order_id, sum(refund_amount) AS total_refunds FROM refunds GROUP BY order_id"
_DISCOUNTED = (
    "SELECT op.order_id, sum(p.discount_amount) AS total_discounts FROM order_promotions op "
    "JOIN promotions p ON op.promotion_id = p.promotion_id GROUP BY op.order_id"
)
_FACT = (
    "SELECT g.order_id, cd.customer_key, td.time_key, sd.store_key, g.channel, g.gross_amount AS gross_revenue, "
    "coalesce(r.total_refunds, 0) AS refund_amount, coalesce(d.total_discounts, 0) AS discount_amount, "
    "g.gross_amount - coalesce(r.total_refunds, 0) - coalesce(d.total_discounts, 0) AS net_revenue, "
    "g.order_date, g.ship_date, g.payment_received_date "
    "FROM gross g LEFT JOIN refunded r ON g.order_id = r.order_id LEFT JOIN discounted d ON g.order_id = d.order_id "
    "JOIN customer_dim cd ON g.customer_id = cd.customer_id AND CAST(g.order_date AS DATE) >= cd.effective_from "
    "AND CAST(g.order_date AS DATE) < cd.effective_to "
    "JOIN time_dim td ON CAST(g.order_date AS DATE) = td.full_date JOIN store_dim sd ON g.store_id = sd.store_id"
)
_FACT_PARTS = {
    "pos_orders": None,
    "items": None,
    "refunds": None,
    "order_promotions": None,
    "promotions": None,
    "customer_dim": None,
    "store_dim": None,
    "time_dim": _TIME_DIM,
    "gross": _GROSS,
    "refunded": _REFUNDED,
    "discounted": _DISCOUNTED,
    "fact": _FACT,
}


def _visits(source: str) -> dict[str, str | None]:
    """Visits from raw transactions, compared one by one."""
    return {
        source: None,
        "gaps": (
            f"SELECT *, CASE WHEN date_diff('minute', lag(order_date) OVER w, order_date) > 15 OR lag(order_date) OVER w IS NULL "
            f"THEN 1 ELSE 0 END AS opens FROM {source} WHERE channel = 'retail' "
            "WINDOW w AS (PARTITION BY customer_id, store_id ORDER BY order_date, order_id)"
        ),
        "grouped": (
            "SELECT *, sum(opens) OVER (PARTITION BY customer_id, store_id ORDER BY order_date, order_id "
            "ROWS UNBOUNDED PRECEDING) AS visit_group FROM gaps"
        ),
        "visits": (
            "SELECT customer_id, store_id, visit_group, min(order_date) AS visit_start, max(order_date) AS visit_end, "
            "count(order_id) AS transaction_count, sum(total_amount) AS visit_total FROM grouped "
            "GROUP BY customer_id, store_id, visit_group"
        ),
    }


_REPORTED = (
    "SELECT store_id, monthname(order_date) AS month_name, CAST(sum(total_amount) AS DOUBLE) / count(*) AS reported_basket_size, "
    "CAST(store_id % 5 + 1 AS DOUBLE) / 100 AS commission_rate FROM pos_orders WHERE channel = 'retail' GROUP BY ALL"
)
_STORE_REVENUE = (
    "SELECT sd.store_id, sd.store_name, sd.manager_name, td.month_name, sum(f.net_revenue) AS revenue FROM fact f "
    "JOIN store_dim sd ON f.store_key = sd.store_key JOIN time_dim td ON f.time_key = td.time_key "
    "WHERE f.channel = 'retail' GROUP BY ALL"
)
_STORE_VISITS = "SELECT store_id, monthname(visit_start) AS month_name, count(*) AS n FROM visits GROUP BY ALL"

_STATUSES = (
    "SELECT * FROM (VALUES ('active', 0, 1), ('completed', 0, 1), ('defaulted', 1, 1), ('restructured', 0, 1), "
    "('restructured_default', 1, 1), ('reversed', 0, 0), ('frozen', 0, 0), ('orphan', 0, 0)) AS s(status_code, num, den)"
)
_RECLASSIFIED = (
    "SELECT plan_id, customer_id, CASE WHEN missed_payment_count >= default_threshold AND restructure_date IS NULL THEN 'defaulted' "
    f"WHEN restructure_date IS NOT NULL AND last_payment_date >= DATE '{retail.AS_OF}' - INTERVAL 2 MONTH THEN 'restructured' "
    "WHEN restructure_date IS NOT NULL AND missed_payment_count >= default_threshold THEN 'restructured_default' "
    "WHEN reversal_date IS NOT NULL THEN 'reversed' "
    "WHEN NOT EXISTS (SELECT 1 FROM customer_ids c WHERE c.customer_id = np.customer_id) THEN 'orphan' "
    "ELSE current_status END AS status_category FROM plans np"
)
_RATE = (
    "SELECT CAST(sum(num) AS BIGINT) AS defaults, CAST(sum(den) AS BIGINT) AS total_plans, "
    "CAST(sum(num) AS DOUBLE) / nullif(sum(den), 0) AS corrected_default_rate "
    "FROM reclassified np JOIN statuses s ON np.status_category = s.status_code"
)
_PLAN_PARTS = {"plans": None, "customer_ids": None, "statuses": _STATUSES, "reclassified": _RECLASSIFIED, "rate": _RATE}

_REASON = (
    "CASE WHEN json_valid({0}) THEN NULL WHEN regexp_full_match({0}, '[ \\t\\r\\n]*') THEN 'empty' "
    "WHEN regexp_matches({0}, '^\\s*[{{\\[].*[}}\\]]\\s*\\S') AND json_valid(regexp_extract({0}, '^\\s*([{{\\[].*[}}\\]])', 1)) "
    "THEN 'trailing_text' ELSE 'not_json' END"
)


def _reason(column: str) -> str:
    return _REASON.format(column)


_DESCRIBED = (
    "SELECT *, CASE WHEN description IS NULL THEN NULL "
    "WHEN NOT regexp_matches(description, '^ *[{\\[]') THEN CAST(json_object('raw_text', description) AS VARCHAR) "
    "WHEN json_valid(description) THEN CAST(json(description) AS VARCHAR) "
    f"ELSE CAST(json_object('parse_error', {_reason('description')}, 'raw_text', description) AS VARCHAR) END AS description_json "
    "FROM products"
)
_DOCUMENTS = "SELECT product_id, CAST(attributes AS JSON) AS doc, attributes ->> '$.category' AS category FROM enrichment"


def _json_type(path: str) -> str:
    return (
        f"CASE json_type(doc, '{path}') WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' "
        f"WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' WHEN NULL THEN NULL "
        f"ELSE CASE WHEN json_type(doc, '{path}') IS NULL THEN NULL ELSE 'number' END END"
    )


_SCREEN_NUMBER = (
    "CASE json_type(doc, '$.screen_size') WHEN 'VARCHAR' THEN TRY_CAST(regexp_replace(doc ->> '$.screen_size', '[^0-9.]', '', 'g') AS BIGINT) "
    "WHEN 'OBJECT' THEN TRY_CAST(doc ->> '$.screen_size.size' AS BIGINT) "
    "WHEN 'ARRAY' THEN TRY_CAST(doc ->> '$.screen_size[0]' AS BIGINT) END"
)
_ODD_SCREEN = "category = 'television' AND json_exists(doc, '$.screen_size') AND json_type(doc, '$.screen_size') NOT IN ('UBIGINT', 'BIGINT', 'DOUBLE')"


def _set_screen(number: str) -> str:
    """Television documents rebuilt field by field, in name order."""
    return (
        "'{\"category\":\"television\"' || CASE WHEN json_exists(doc, '$.resolution') THEN ',\"resolution\":' || (doc -> '$.resolution') ELSE '' END "
        f"|| ',\"screen_size\":' || coalesce(CAST({number} AS VARCHAR), 'null') || "
        "CASE WHEN json_exists(doc, '$.smart_tv') THEN ',\"smart_tv\":' || (doc -> '$.smart_tv') ELSE '' END || '}'"
    )


_CONTRACTS = (
    "SELECT * FROM (VALUES ('television', 'screen_size', 'number', true), ('television', 'resolution', 'string', true), "
    "('television', 'smart_tv', 'boolean', true), ('refrigerator', 'capacity_liters', 'number', true), "
    "('refrigerator', 'energy_rating', 'string', true), ('refrigerator', 'frost_free', 'boolean', false)) "
    "AS c(category, field, expected, required)"
)

_CLASSIFIED = (
    "SELECT customer_id, card_last_sixteen IS NOT NULL AS pan_present, CAST(length(card_last_sixteen) AS DOUBLE) AS pan_length, "
    "false AS retention_required, CASE WHEN card_last_sixteen IS NULL THEN 'NO_PAN' "
    "WHEN length(card_last_sixteen) = 16 THEN 'FULL_PAN_FOUND' ELSE 'UNKNOWN_FORMAT' END AS classification_status, "
    "CASE WHEN card_last_sixteen IS NULL THEN 'NO_ACTION' WHEN length(card_last_sixteen) = 16 THEN 'TOKENIZE_OR_PURGE' "
    "ELSE 'MANUAL_REVIEW' END AS action_required FROM legacy_customers"
)
_TOKENS = (
    "SELECT customer_id, 'tok_' || md5(card_last_sixteen || CAST(customer_id AS VARCHAR)) AS pan_token, "
    "right(card_last_sixteen, 4) AS pan_last_four FROM legacy_customers WHERE card_last_sixteen IS NOT NULL"
)
_VAULTED = (
    "SELECT customer_id, card_last_sixteen, CASE WHEN EXISTS (SELECT 1 FROM pos_orders o WHERE o.customer_id = c.customer_id "
    f"AND o.order_date >= DATE '{retail.AS_OF}' - INTERVAL 18 MONTH) THEN 'active' ELSE 'expired' END AS retention_state "
    "FROM legacy_customers c WHERE card_last_sixteen IS NOT NULL"
)


def _image(alias: str) -> str:
    return (
        f"CASE WHEN {alias}.customer_id IS NOT NULL THEN CAST(json_object('customer_id', {alias}.customer_id, 'segment', {alias}.segment, "
        f"'balance', {alias}.balance, 'city', {alias}.city) AS VARCHAR) END"
    )


_AUDIT = (
    "SELECT 'customers' AS table_name, CASE WHEN b.customer_id IS NULL THEN 'INSERT' WHEN a.customer_id IS NULL THEN 'DELETE' "
    "ELSE 'UPDATE' END AS action_name, CAST(coalesce(a.customer_id, b.customer_id) AS VARCHAR) AS record_id, "
    f"{_image('b')} AS old_data, {_image('a')} AS new_data FROM snapshot_before b FULL JOIN snapshot_after a "
    "ON a.customer_id = b.customer_id WHERE b.customer_id IS NULL OR a.customer_id IS NULL OR b.segment IS DISTINCT FROM a.segment "
    "OR b.balance IS DISTINCT FROM a.balance OR b.city IS DISTINCT FROM a.city"
)
_RANK = "CASE priority WHEN 'Critical' THEN 1 WHEN 'High' THEN 2 WHEN 'Medium' THEN 3 ELSE 4 END"


def _day(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d') AS {name or column.split('.')[-1]}"


def _moment(column: str, name: str | None = None) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f') AS {name or column.split('.')[-1]}"


def _amount(column: str, name: str | None = None) -> str:
    return f"CAST({column} AS DOUBLE) AS {name or column.split('.')[-1]}"


def _sql(parts: dict[str, str | None] | list[str], body: str, recursive: bool = False) -> str:
    """``body`` with its inputs in front; a part without text is a shaped input."""
    named = parts if isinstance(parts, dict) else {name: None for name in parts}
    steps = ", ".join(f"{name} AS ({text if text else retail.as_sql(name)})" for name, text in named.items())
    return f"WITH {'RECURSIVE ' if recursive else ''}{steps} {body}"


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}

    out["net_revenue_fact"] = _sql(
        {**_FACT_PARTS, "loaded_orders": None},
        "SELECT order_id, customer_key, time_key, store_key, channel, "
        f"{_amount('gross_revenue')}, {_amount('refund_amount')}, {_amount('discount_amount')}, {_amount('net_revenue')}, "
        f"{_moment('order_date')}, {_day('ship_date')}, {_day('payment_received_date')} FROM fact "
        "WHERE order_id NOT IN (SELECT order_id FROM loaded_orders)",
    )
    out["fact_repair"] = _sql(
        _FACT_PARTS,
        "SELECT order_id, customer_key, time_key, store_key, channel, "
        f"{_amount('gross_revenue')}, {_amount('refund_amount')}, {_amount('discount_amount')}, {_amount('net_revenue')}, "
        f"{_moment('order_date')}, {_day('ship_date')}, {_day('payment_received_date')} FROM fact",
    )
    out["fact_repair_stored"] = _sql(
        _FACT_PARTS, "SELECT 'MATCH' AS verdict, count(*) AS orders, CAST(0 AS DOUBLE) AS difference FROM fact"
    )
    out["gross_revenue_by_order"] = _sql(
        {"pos_orders": None, "items": None, "gross": _GROSS},
        f"SELECT order_id, customer_id, {_moment('order_date')}, {_day('ship_date')}, {_day('payment_received_date')}, "
        f"store_id, channel, {_amount('gross_amount')} FROM gross",
    )
    out["refunds_by_order"] = _sql(
        {"refunds": None, "refunded": _REFUNDED}, f"SELECT order_id, {_amount('total_refunds')} FROM refunded"
    )
    out["discounts_by_order"] = _sql(
        {"order_promotions": None, "promotions": None, "discounted": _DISCOUNTED},
        f"SELECT order_id, {_amount('total_discounts')} FROM discounted",
    )
    for name, end in (("scd2_as_of_join", "<"), ("scd2_as_of_join_asis", "<=")):
        out[name] = _sql(
            ["pos_orders", "customer_dim"],
            "SELECT o.order_id, o.customer_id, d.customer_key, d.city FROM pos_orders o JOIN customer_dim d "
            "ON o.customer_id = d.customer_id AND CAST(o.order_date AS DATE) >= d.effective_from "
            f"AND CAST(o.order_date AS DATE) {end} d.effective_to",
        )
    out["incremental_new_orders"] = _sql(
        ["pos_orders", "loaded_orders"],
        "SELECT order_id, customer_id, status FROM pos_orders WHERE order_id NOT IN (SELECT order_id FROM loaded_orders)",
    )
    out["scd2_backfill"] = _sql(
        ["type1_customer_dim", "urgent_sales"],
        "SELECT customer_key, customer_id, city, strftime(coalesce((SELECT min(CAST(order_date AS DATE)) FROM urgent_sales s "
        "WHERE s.customer_key = d.customer_key), DATE '2023-01-01'), '%Y-%m-%d') AS effective_from, "
        "'9999-12-31' AS effective_to, true AS is_current FROM type1_customer_dim d",
    )
    attributes = "first_name, last_name, email, city, province"
    out["scd2_apply_changes"] = _sql(
        {
            "customer_dim": None,
            "staging_customers": None,
            "latest": "SELECT * FROM staging_customers QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY loaded_at DESC) = 1",
            "changed": "SELECT s.* FROM latest s JOIN customer_dim d ON s.customer_id = d.customer_id WHERE d.is_current "
            "AND (d.city IS DISTINCT FROM s.city OR d.province IS DISTINCT FROM s.province)",
        },
        f"SELECT {_amount('customer_key')}, customer_id, {attributes}, {_day('effective_from')}, "
        f"CASE WHEN is_current AND customer_id IN (SELECT customer_id FROM changed) THEN '{retail.AS_OF}' "
        "ELSE CASE WHEN is_current THEN '9999-12-31' ELSE strftime(effective_to, '%Y-%m-%d') END END AS effective_to, "
        "is_current AND customer_id NOT IN (SELECT customer_id FROM changed) AS is_current FROM customer_dim "
        f"UNION ALL SELECT NULL, customer_id, {attributes}, '{retail.AS_OF}', '9999-12-31', true FROM changed "
        f"UNION ALL SELECT NULL, customer_id, {attributes}, '{retail.AS_OF}', '9999-12-31', true FROM latest "
        "WHERE customer_id NOT IN (SELECT customer_id FROM customer_dim)",
    )
    out["payment_time_key"] = _sql(
        {"pos_orders": None, "time_dim": _TIME_DIM},
        f"SELECT order_id, {_day('payment_received_date')}, {_amount('time_key', 'payment_time_key')} FROM pos_orders "
        "LEFT JOIN time_dim ON payment_received_date = full_date",
    )
    for name, day, total in (
        ("tax_revenue_by_quarter", "payment_received_date", "revenue_for_tax"),
        ("mgmt_revenue_by_quarter", "order_date", "revenue_for_reporting"),
    ):
        out[name] = _sql(
            _FACT_PARTS,
            f"SELECT td.fiscal_quarter, td.fiscal_year, CAST(sum(f.net_revenue) AS DOUBLE) AS {total} FROM fact f "
            f"JOIN time_dim td ON CAST(f.{day} AS DATE) = td.full_date GROUP BY ALL ORDER BY 2, 1",
        )
    out["retail_visits"] = _sql(
        _visits("pos_events"),
        f"SELECT customer_id, store_id, CAST(visit_group AS BIGINT) AS visit_group, {_moment('visit_start')}, {_moment('visit_end')}, "
        f"transaction_count, {_amount('visit_total')}, {_amount('visit_total', 'corrected_basket_size')} FROM visits",
    )
    basket_parts = {**_FACT_PARTS, **_visits("pos_orders"), "revenue": _STORE_REVENUE, "counted": _STORE_VISITS}
    out["corrected_basket_size"] = _sql(
        basket_parts,
        "SELECT r.store_name, r.month_name, CAST(r.revenue AS DOUBLE) AS total_revenue, coalesce(v.n, 0) AS visit_count, "
        "CAST(r.revenue AS DOUBLE) / nullif(CAST(coalesce(v.n, 0) AS DOUBLE), 0) AS corrected_basket_size FROM revenue r "
        "LEFT JOIN counted v ON r.store_id = v.store_id AND r.month_name = v.month_name",
    )
    out["commission_backpay"] = _sql(
        {
            **basket_parts,
            "reported": _REPORTED,
            "totals": "SELECT r.store_name, r.manager_name, sum(r.revenue) AS revenue, sum(coalesce(v.n, 0)) AS n, "
            "min(oc.reported_basket_size) AS reported_basket, min(oc.commission_rate) AS rate FROM revenue r "
            "LEFT JOIN counted v ON r.store_id = v.store_id AND r.month_name = v.month_name "
            "JOIN reported oc ON r.store_id = oc.store_id AND r.month_name = oc.month_name GROUP BY ALL",
        },
        "SELECT store_name, manager_name, CAST(revenue AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0) AS corrected_basket, reported_basket, "
        "(CAST(revenue AS DOUBLE) / nullif(CAST(n AS DOUBLE), 0) - reported_basket) * rate AS underpayment FROM totals",
    )
    literal_join = (
        "FROM fact sf JOIN store_dim sd ON sf.store_key = sd.store_key JOIN time_dim td ON sf.time_key = td.time_key "
        "LEFT JOIN visits rv ON sf.customer_key = rv.customer_id AND sf.store_key = rv.store_id "
    )
    per_visit = "CAST(sum(sf.net_revenue) AS DOUBLE) / nullif(CAST(count(DISTINCT rv.visit_group) AS DOUBLE), 0)"
    asis_parts = {**_FACT_PARTS, **_visits("pos_orders")}
    out["corrected_basket_size_asis"] = _sql(
        asis_parts,
        "SELECT sd.store_name, td.month_name, CAST(sum(sf.net_revenue) AS DOUBLE) AS total_revenue, "
        f"count(DISTINCT rv.visit_group) AS visit_count, {per_visit} AS corrected_basket_size {literal_join} "
        "WHERE sf.channel = 'retail' GROUP BY sd.store_name, td.month_name",
    )
    out["commission_backpay_asis"] = _sql(
        {**asis_parts, "reported": _REPORTED},
        f"SELECT sd.store_name, sd.manager_name, {per_visit} AS corrected_basket, min(oc.reported_basket_size) AS reported_basket, "
        f"({per_visit} - min(oc.reported_basket_size)) * min(oc.commission_rate) AS underpayment {literal_join} "
        "JOIN reported oc ON sd.store_id = oc.store_id AND td.month_name = oc.month_name "
        "WHERE sf.channel = 'retail' GROUP BY sd.store_name, sd.manager_name",
    )
    out["inventory_snapshot_capture"] = _sql(
        ["current_inventory"],
        "SELECT product_id, store_id, quantity_available AS quantity_on_hand, '2024-02-01 10:00:00.000000' AS snapshot_time, "
        "'2024-02-01' AS snapshot_date FROM current_inventory",
    )
    taken = " UNION ALL ".join(
        f"SELECT *, TIMESTAMP '{catalog.SNAPSHOT_AT}' + INTERVAL {hours} HOUR AS taken_at FROM current_inventory" for hours in catalog.SNAPSHOT_HOURS
    )
    out["inventory_snapshot_history"] = _sql(
        {"current_inventory": None, "taken": taken},
        "SELECT strftime(taken_at, '%Y-%m-%d') AS snapshot_date, "
        "strftime(taken_at, '%Y-%m-%d %H:%M:%S.%f') AS snapshot_time, store_id, count(*) AS products, "
        "CAST(sum(quantity_available) AS BIGINT) AS units FROM taken GROUP BY ALL",
    )
    turnover_parts = ["line_fact", "product_dim", "inventory_snapshots"]
    out["inventory_turnover"] = _sql(
        {
            **dict.fromkeys(turnover_parts),
            "sold": "SELECT product_key, sum(net_revenue) AS revenue FROM line_fact GROUP BY ALL",
            "held": "SELECT p.product_key, p.product_id, p.product_name, CAST(sum(s.quantity_on_hand * p.unit_cost) AS DOUBLE) / count(*) AS avg_value "
            "FROM product_dim p JOIN inventory_snapshots s ON p.product_id = s.product_id GROUP BY ALL",
        },
        "SELECT h.product_id, h.product_name, CAST(s.revenue AS DOUBLE) AS cogs_proxy, h.avg_value AS avg_inventory_value, "
        "CAST(s.revenue AS DOUBLE) / nullif(h.avg_value, 0) AS corrected_turnover FROM sold s JOIN held h ON s.product_key = h.product_key",
    )
    average = "(CAST(sum(i.quantity_on_hand * p.unit_cost) AS DOUBLE) / count(*))"
    out["inventory_turnover_asis"] = _sql(
        turnover_parts,
        f"SELECT p.product_id, p.product_name, CAST(sum(f.net_revenue) AS DOUBLE) AS cogs_proxy, {average} AS avg_inventory_value, "
        f"CAST(sum(f.net_revenue) AS DOUBLE) / nullif({average}, 0) AS corrected_turnover FROM line_fact f "
        "JOIN product_dim p ON f.product_key = p.product_key JOIN inventory_snapshots i ON p.product_id = i.product_id "
        "AND f.order_date BETWEEN i.snapshot_date AND i.snapshot_date + 1 GROUP BY p.product_id, p.product_name",
    )
    out["plan_status_reclassify"] = _sql(
        {"plans": None, "customer_ids": None, "reclassified": _RECLASSIFIED}, "SELECT * FROM reclassified"
    )
    out["plan_default_rate"] = _sql(_PLAN_PARTS, "SELECT * FROM rate")
    reported_rate, portfolio = float(catalog.REPORTED_RATE), float(catalog.PORTFOLIO)
    gap = f"(CAST({reported_rate} AS DOUBLE) - corrected_default_rate)"
    out["reserve_overstatement"] = _sql(
        _PLAN_PARTS,
        f"SELECT CAST({reported_rate} AS DOUBLE) AS reported_rate, corrected_default_rate, CAST(CAST({gap} AS DECIMAL(20,12)) AS DOUBLE) AS variance, "
        f"CAST(CAST(CAST({gap} AS DECIMAL(20,12)) * CAST({portfolio} AS DECIMAL(11,0)) AS DECIMAL(28,4)) AS DOUBLE) AS over_provisioned FROM rate",
    )
    out["fact_source_reconcile"] = _sql(
        {
            "stale_fact": None,
            "pos_orders": None,
            "stale_source_items": None,
            "source": "SELECT o.order_id, sum(i.unit_price * i.qty) AS source_gross FROM pos_orders o JOIN stale_source_items i "
            "ON o.order_id = i.order_id WHERE o.status NOT LIKE 'cancelled%' GROUP BY ALL",
        },
        "SELECT coalesce(f.order_id, s.order_id) AS order_id, CAST(f.gross_revenue AS DOUBLE) AS fact_gross, "
        "CAST(s.source_gross AS DOUBLE) AS source_gross, CASE WHEN f.order_id IS NULL THEN 'MISSING_IN_FACT' "
        "WHEN s.order_id IS NULL THEN 'MISSING_IN_SOURCE' WHEN f.gross_revenue <> s.source_gross THEN 'AMOUNT_MISMATCH' "
        "ELSE 'MATCH' END AS verdict, CAST(coalesce(f.gross_revenue, 0) - coalesce(s.source_gross, 0) AS DOUBLE) AS difference "
        "FROM stale_fact f FULL JOIN source s ON f.order_id = s.order_id",
    )

    out["null_inapplicable_values"] = _sql(
        ["products"],
        "SELECT product_id, product_type, CASE WHEN product_type IN ('financial', 'digital', 'logistics') THEN NULL "
        "ELSE CAST(weight_kg AS DOUBLE) END AS weight_kg FROM products",
    )
    out["text_to_json_or_wrap"] = _sql(
        {"products": None, "described": _DESCRIBED}, "SELECT product_id, description_json FROM described"
    )
    out["json_profile_split"] = _sql(
        ["profiles"],
        "SELECT customer_id, CASE WHEN json_valid(profile_data) THEN profile_data END AS profile_data, "
        "CASE WHEN json_valid(profile_data) THEN CAST(json(profile_data) AS VARCHAR) END AS profile_data_json FROM profiles",
    )
    letters = (
        f"SELECT customer_id, profile_data AS malformed_payload, {_reason('profile_data')} AS failure_reason FROM profile_writes "
        "WHERE profile_data IS NOT NULL AND NOT json_valid(profile_data) "
        "QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY written DESC) = 1"
    )
    out["json_dead_letter"] = _sql(["profile_writes"], letters)
    profile = " UNION ALL ".join(
        f"SELECT '{key}' AS attribute, {_json_type('$.' + key)} AS json_type, left(doc ->> '$.{key}', 50) AS sample_value, "
        f"count(*) AS occurrences FROM documents WHERE category = 'television' AND json_exists(doc, '$.{key}') GROUP BY ALL"
        for key in ("screen_size", "display_size")
    )
    doc_parts = {"enrichment": None, "documents": _DOCUMENTS}
    out["json_attribute_profile"] = _sql(doc_parts, profile)
    node = "regexp_replace(t.fullkey, '\\[[0-9]+\\]', '[*]', 'g')"
    kind = (
        "CASE t.type WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' "
        "WHEN 'NULL' THEN 'null' ELSE 'number' END"
    )
    out["json_discovery"] = _sql(
        {
            **doc_parts,
            "nodes": f"SELECT {node} AS path, {kind} AS json_type, left(CASE WHEN t.type = 'VARCHAR' THEN t.value ->> '$' "
            "ELSE CAST(t.value AS VARCHAR) END, 50) AS sample FROM documents d, json_tree(d.doc) t",
        },
        "SELECT path, json_type, min(sample) AS sample_value, count(*) AS occurrences, "
        "(SELECT count(DISTINCT json_type) FILTER (WHERE json_type <> 'null') > 1 FROM nodes m WHERE m.path = n.path) AS mixed_types "
        "FROM nodes n GROUP BY path, json_type",
    )
    out["json_normalize_numeric"] = _sql(
        doc_parts,
        f"SELECT product_id, CASE WHEN {_ODD_SCREEN} THEN {_set_screen(_SCREEN_NUMBER)} ELSE CAST(doc AS VARCHAR) END AS attributes FROM documents",
    )
    display = "TRY_CAST(regexp_replace(doc ->> '$.display_size', '[^0-9.]', '', 'g') AS BIGINT)"
    out["json_alias_merge"] = _sql(
        doc_parts,
        "SELECT product_id, CASE WHEN category = 'television' AND json_exists(doc, '$.display_size') AND NOT json_exists(doc, '$.screen_size') "
        f"THEN {_set_screen(display)} WHEN {_ODD_SCREEN} THEN {_set_screen(_SCREEN_NUMBER)} ELSE CAST(doc AS VARCHAR) END AS attributes FROM documents",
    )
    out["json_contract_check"] = _sql(
        doc_parts,
        "SELECT product_id, NOT coalesce((category = 'television' AND json_exists(doc, '$.screen_size') AND "
        f"{_json_type('$.screen_size')} <> 'number') OR (category = 'refrigerator' AND json_exists(doc, '$.capacity_liters') AND "
        f"{_json_type('$.capacity_liters')} <> 'number'), false) AS is_valid FROM documents",
    )
    found = "CASE " + " ".join(
        f"WHEN c.field = '{field}' THEN {_json_type('$.' + field)}"
        for field in ("screen_size", "resolution", "smart_tv", "capacity_liters", "energy_rating", "frost_free")
    ) + " END"
    out["json_schema_validate"] = _sql(
        {
            **doc_parts,
            "contracts": _CONTRACTS,
            "checked": f"SELECT d.product_id, d.category, c.field, c.expected, c.required, {found} AS found "
            "FROM documents d JOIN contracts c ON d.category = c.category",
        },
        "SELECT product_id, category, field, expected, found, CASE WHEN found IS NULL THEN 'missing' ELSE 'wrong_type' END AS problem "
        "FROM checked WHERE (found IS NULL AND required) OR found <> expected",
    )
    out["broken_rules_by_product"] = (
        "SELECT product_id, string_agg(concat(field, ' ', problem), ', ' ORDER BY concat(field, ' ', problem)) AS rules "
        f"FROM ({out['json_schema_validate']}) AS broken GROUP BY product_id"
    )
    rules = {
        "channel_known": "channel IN ('online', 'retail')",
        "status_known": "status IN ('completed', 'cancelled', 'cancelled_fraud')",
        "total_not_negative": "total_amount >= 0",
        "total_below_limit": "total_amount < 400000",
        "customer_present": "customer_id IS NOT NULL",
        "shipped_before_paid": "ship_date <= payment_received_date",
    }
    out["constraint_report"] = _sql(
        ["pos_orders", "items"],
        " UNION ALL ".join(
            f"SELECT '{name}' AS rule, count(*) FILTER (WHERE NOT ({rule})) AS violations FROM pos_orders" for name, rule in rules.items()
        )
        + " UNION ALL SELECT 'order_product_unique', (SELECT count(*) FROM items) - (SELECT count(*) FROM "
        "(SELECT DISTINCT order_id, product_id FROM items))",
    )
    out["fk_violations"] = _sql(
        ["plans", "customer_ids"],
        "SELECT plan_id, customer_id FROM plans p WHERE customer_id IS NOT NULL AND NOT EXISTS "
        "(SELECT 1 FROM customer_ids c WHERE c.customer_id = p.customer_id)",
    )
    out["orphan_reparent"] = _sql(
        ["plans", "customer_ids"],
        "SELECT plan_id, CASE WHEN customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM customer_ids c "
        "WHERE c.customer_id = p.customer_id) THEN -1 ELSE customer_id END AS customer_id FROM plans p",
    )
    holding = catalog.HOLDING
    out["ensure_default_parent"] = _sql(
        ["legacy_customers"],
        f"SELECT customer_id, full_name, email, phone, card_last_sixteen, {_day('created_at')} FROM legacy_customers UNION ALL "
        f"SELECT -1, '{holding['name']}', '{holding['email']}', 'holding', 'holding', '{holding['as_of']:%Y-%m-%d}'",
    )
    out["remediation_scoreboard"] = _sql(
        ["products", "legacy_customers", "profiles", "profile_writes"],
        "SELECT 'invalid_product_weights' AS item, CAST(0 AS BIGINT) AS value "
        "UNION ALL SELECT 'populated_product_descriptions', count(description) FROM products "
        "UNION ALL SELECT 'pan_rows_remaining_in_customers', 0 "
        "UNION ALL SELECT 'customers_with_json_profiles', count(*) FILTER (WHERE json_valid(profile_data)) FROM profiles "
        "UNION ALL SELECT 'pan_rows_in_vault', count(card_last_sixteen) FROM legacy_customers "
        "UNION ALL SELECT 'malformed_profiles_deadlettered', count(DISTINCT customer_id) FROM profile_writes "
        "WHERE profile_data IS NOT NULL AND NOT json_valid(profile_data)",
    )
    out["shard_consolidate"] = _sql(
        {
            "customer_shard_am": None,
            "customer_shard_nz": None,
            "merged": "SELECT * FROM customer_shard_am UNION ALL SELECT * FROM customer_shard_nz",
        },
        "SELECT customer_id, last_name, city, count(*) OVER (PARTITION BY customer_id) AS copies FROM merged",
    )
    out["shard_dump_load"] = _sql(
        {"dumped_am": None, "dumped_nz": None, "merged": "SELECT * FROM dumped_am UNION ALL SELECT * FROM dumped_nz"},
        "SELECT customer_id, last_name, city, count(*) OVER (PARTITION BY customer_id) AS copies FROM merged",
    )

    out["pan_classify"] = _sql(["legacy_customers"], _CLASSIFIED)
    out["pan_tokenize"] = _sql(["legacy_customers"], _TOKENS)
    out["pan_purge"] = _sql(
        ["legacy_customers"], "SELECT customer_id, full_name, CAST(NULL AS VARCHAR) AS card_last_sixteen FROM legacy_customers"
    )
    out["pan_vault_upsert"] = _sql(
        {"legacy_customers": None, "pos_orders": None, "stored_vault": None, "vaulted": _VAULTED},
        f"SELECT customer_id, retention_state, '{retail.AS_OF}' AS captured_at, card_last_sixteen AS pan_after_decrypt FROM vaulted "
        f"UNION ALL SELECT customer_id, retention_state, {_day('captured_at')}, 'held before' FROM stored_vault "
        "WHERE customer_id NOT IN (SELECT customer_id FROM vaulted)",
    )
    out["pan_remediation_report"] = _sql(
        {"legacy_customers": None, "classified": _CLASSIFIED, "tokens": _TOKENS},
        "SELECT c.customer_id, pan_present, pan_length, classification_status, action_required, pan_token, pan_last_four "
        "FROM classified c LEFT JOIN tokens t ON t.customer_id = c.customer_id",
    )
    out["masked_customer_view"] = _sql(
        ["legacy_customers"], f"SELECT customer_id, full_name, email, phone, {_day('created_at')} FROM legacy_customers"
    )
    out["remediation_scoreboard_observed"] = out["remediation_scoreboard"]
    out["audit_change_log"] = _sql(["snapshot_before", "snapshot_after"], _AUDIT)
    event_type, description, severity = catalog.PAN_EVENT
    out["suspicious_event_if_exists"] = _sql(
        {"legacy_customers": None, "classified": _CLASSIFIED},
        f"SELECT '{event_type}' AS event_type, '{description}' AS description, '{severity}' AS severity "
        "WHERE EXISTS (SELECT 1 FROM classified WHERE classification_status = 'FULL_PAN_FOUND')",
    )

    left_over = "SELECT product_id, rating FROM reviews_left UNION ALL SELECT new_product_id, new_rating FROM review_changes WHERE new_product_id IS NOT NULL"
    out["product_ratings_incremental"] = _sql(
        {"reviews_left": None, "review_changes": None, "after": left_over},
        "SELECT product_id, CAST(sum(rating) AS DOUBLE) / nullif(count(rating), 0) AS avg_rating, count(rating) AS review_count FROM after GROUP BY product_id",
    )
    out["search_copy_reconcile"] = _sql(
        ["live_products", "search_copy"],
        "SELECT coalesce(l.product_id, c.product_id) AS product_id, CASE WHEN c.product_id IS NULL THEN 'MISSING' WHEN l.product_id IS NULL THEN 'SURPLUS' "
        "ELSE 'STALE' END AS verdict FROM live_products l FULL JOIN search_copy c ON l.product_id = c.product_id "
        "WHERE c.product_id IS NULL OR l.product_id IS NULL OR l.name IS DISTINCT FROM c.name OR l.price IS DISTINCT FROM c.price",
    )
    out["customer_contacts_lateral"] = _sql(
        ["asked_contacts", "legacy_customers"],
        "SELECT a.request_id, a.customer_id, c.full_name, c.email, c.phone FROM asked_contacts a LEFT JOIN legacy_customers c ON c.customer_id = a.customer_id",
    )
    ratings = "SELECT product_id, CAST(sum(rating) AS DOUBLE) / count(rating) AS avg_rating, count(rating) AS review_count FROM reviews GROUP BY product_id"
    out["product_ratings"] = _sql({"reviews": None, "ratings": ratings}, "SELECT * FROM ratings")
    out["product_search_nested"] = _sql(
        {"reviews": None, "ratings": ratings, "nested_products": None},
        "SELECT p.product_id, p.description_json, r.avg_rating FROM nested_products p LEFT JOIN ratings r ON p.product_id = r.product_id "
        "WHERE json_contains(p.description_json, '{\"maker\":{\"name\":\"Brand#8\"},\"tags\":[\"all\"],\"size\":2,\"it\'\'s\":true}') "
        "ORDER BY p.product_id LIMIT 50",
    )
    out["product_search"] = _sql(
        {"reviews": None, "ratings": ratings, "products": None, "described": _DESCRIBED},
        "SELECT p.product_id, p.description_json, r.avg_rating FROM described p LEFT JOIN ratings r ON p.product_id = r.product_id "
        "WHERE json_contains(p.description_json, '{\"raw_text\":\"red widget\"}') ORDER BY p.product_id LIMIT 50",
    )
    out["order_tracking"] = _sql(
        ["pos_orders", "items"],
        "SELECT o.order_id, o.status, i.product_id, i.qty FROM pos_orders o JOIN items i ON o.order_id = i.order_id "
        f"WHERE o.customer_id = {catalog.TRACKED_CUSTOMER}",
    )
    out["high_frequency_customers"] = _sql(
        ["pos_orders"],
        "SELECT customer_id, count(order_id) AS order_count FROM pos_orders GROUP BY customer_id HAVING count(order_id) > 5",
    )
    out["customer_by_id"] = _sql(
        ["legacy_customers"],
        f"SELECT customer_id, full_name, email, phone FROM legacy_customers WHERE customer_id = {catalog.TRACKED_CUSTOMER}",
    )
    out["customer_by_email"] = _sql(
        ["legacy_customers"],
        "SELECT customer_id, full_name, email, phone FROM legacy_customers WHERE email = 'customer#000000007@example.com'",
    )
    out["order_inventory_join"] = _sql(
        {
            "store_orders": None,
            "current_inventory": None,
            "stock": "SELECT product_id, store_id, sum(quantity_available) AS quantity_available FROM current_inventory GROUP BY ALL",
        },
        "SELECT o.order_id, o.customer_id, o.product_id, o.store_id, CAST(s.quantity_available AS BIGINT) AS quantity_available "
        "FROM store_orders o JOIN stock s ON o.product_id = s.product_id AND o.store_id = s.store_id",
    )
    out["top_slow_queries"] = _sql(
        ["query_log"],
        "SELECT queryid, left(query, 100) AS normalized_query_stub, count(*) AS calls, "
        "CAST(sum(exec_ms) AS DOUBLE) / 1000 / 60 AS total_minutes_spent, CAST(sum(exec_ms) AS DOUBLE) / count(*) AS avg_ms_per_call "
        "FROM query_log GROUP BY ALL ORDER BY sum(exec_ms) DESC, 1, 2 LIMIT 20",
    )
    out["stock_reserve"] = _sql(
        {
            "stock_requests": None,
            "numbered": "SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY order_id, line_no, supplier_id, price) AS n "
            "FROM stock_requests",
            "replay": f"SELECT n, store_id, product_id, order_id, line_no, supplier_id, price, qty, qty <= {catalog.SHELF_STOCK} AS ok, "
            f"{catalog.SHELF_STOCK} - CASE WHEN qty <= {catalog.SHELF_STOCK} THEN qty ELSE 0 END AS left_over FROM numbered WHERE n = 1 "
            "UNION ALL SELECT r.n, r.store_id, r.product_id, r.order_id, r.line_no, r.supplier_id, r.price, r.qty, r.qty <= p.left_over, "
            "p.left_over - CASE WHEN r.qty <= p.left_over THEN r.qty ELSE 0 END FROM replay p JOIN numbered r "
            "ON r.store_id = p.store_id AND r.product_id = p.product_id AND r.n = p.n + 1",
        },
        "SELECT order_id, line_no, supplier_id, CAST(price AS DOUBLE) AS price, store_id, product_id, qty, "
        "CASE WHEN ok THEN 'ACCEPTED' ELSE 'REFUSED' END AS outcome, left_over AS stock_after FROM replay",
        recursive=True,
    )
    out["place_orders_atomic"] = _sql(
        {
            "checkout_orders": None,
            "checkout_items": None,
            "wanted": "SELECT o.store_id, o.order_id, i.product_id, sum(i.qty) AS qty FROM checkout_items i "
            "JOIN checkout_orders o ON i.order_id = o.order_id GROUP BY ALL",
            "numbered": "SELECT store_id, order_id, row_number() OVER (PARTITION BY store_id ORDER BY seq) AS n FROM checkout_orders "
            "WHERE order_id IN (SELECT order_id FROM wanted)",
            "shelf": f"SELECT DISTINCT 0 AS n, store_id, product_id, CAST(NULL AS BIGINT) AS order_id, "
            f"CAST({catalog.CHECKOUT_STOCK} AS BIGINT) AS left_over, true AS fits FROM wanted",
            # One step settles the next order of every store against all shelves of that store.
            "replay": "SELECT * FROM shelf UNION ALL SELECT n, store_id, product_id, order_id, "
            "CAST(left_over - CASE WHEN fits THEN qty ELSE 0 END AS BIGINT), fits FROM ("
            "SELECT o.n, s.store_id, s.product_id, o.order_id, s.left_over, coalesce(w.qty, 0) AS qty, "
            "bool_and(coalesce(w.qty, 0) <= s.left_over) OVER (PARTITION BY s.store_id) AS fits FROM replay s "
            "JOIN numbered o ON o.store_id = s.store_id AND o.n = s.n + 1 "
            "LEFT JOIN wanted w ON w.order_id = o.order_id AND w.product_id = s.product_id) AS step",
        },
        "SELECT DISTINCT order_id, store_id, CASE WHEN fits THEN 'ACCEPTED' ELSE 'REFUSED' END AS outcome FROM replay WHERE n > 0",
        recursive=True,
    )
    out["credit_adjust_versioned"] = _sql(
        {
            "credit_requests": None,
            "credit_accounts": None,
            "numbered": "SELECT r.*, a.available_credit, a.version, row_number() OVER (PARTITION BY r.customer_id ORDER BY r.request_id) AS n "
            "FROM credit_requests r LEFT JOIN credit_accounts a ON r.customer_id = a.customer_id",
            "replay": "SELECT n, request_id, customer_id, expected_version, amount, coalesce(expected_version = version, false) AS ok, "
            "CAST(available_credit + CASE WHEN expected_version = version THEN amount ELSE 0 END AS DECIMAL(18,2)) AS credit, "
            "version + CASE WHEN expected_version = version THEN 1 ELSE 0 END AS version FROM numbered WHERE n = 1 "
            "UNION ALL SELECT r.n, r.request_id, r.customer_id, r.expected_version, r.amount, coalesce(r.expected_version = p.version, false), "
            "CAST(p.credit + CASE WHEN r.expected_version = p.version THEN r.amount ELSE 0 END AS DECIMAL(18,2)), "
            "p.version + CASE WHEN r.expected_version = p.version THEN 1 ELSE 0 END "
            "FROM replay p JOIN numbered r ON r.customer_id = p.customer_id AND r.n = p.n + 1",
        },
        "SELECT request_id, customer_id, expected_version, CAST(amount AS DOUBLE) AS amount, CASE WHEN ok THEN 'APPLIED' ELSE 'CONFLICT' END AS outcome, "
        "CASE WHEN ok THEN CAST(credit AS DOUBLE) END AS credit_after, CASE WHEN ok THEN CAST(version AS DOUBLE) END AS version_after FROM replay",
        recursive=True,
    )

    out["list_partition_read"] = _sql(
        ["current_inventory"],
        "SELECT store_id, count(*) AS items, CAST(sum(quantity_available) AS BIGINT) AS stock FROM current_inventory GROUP BY store_id",
    )
    out["list_partition_one_store"] = _sql(
        ["current_inventory"], f"SELECT product_id, store_id, quantity_available FROM current_inventory WHERE store_id = {catalog.ONE_STORE}"
    )
    out["hash_partition_counts"] = _sql(
        ["legacy_customers"],
        "SELECT CAST(CAST('0x' || left(md5(CAST(customer_id AS VARCHAR)), 8) AS BIGINT) % 8 AS BIGINT) AS bucket, count(*) AS rows "
        "FROM legacy_customers GROUP BY 1",
    )
    out["month_partition_read"] = _sql(
        ["dated_orders"],
        "SELECT CASE WHEN order_date < DATE '2025-07-01' THEN 'archive' WHEN order_date >= DATE '2026-07-01' THEN 'overflow' "
        "ELSE strftime(order_date, '%Y-%m') END AS order_month, count(*) AS orders, CAST(sum(total_amount) AS DOUBLE) AS amount "
        "FROM dated_orders GROUP BY ALL",
    )
    out["partition_backfill"] = _sql(
        ["current_inventory"],
        "SELECT product_id, count(*) AS rows, CAST(sum(quantity_available) AS BIGINT) AS stock FROM current_inventory GROUP BY product_id",
    )

    columns = "problem_id, problem_area, problem_title, priority"
    out["critical_issue_report"] = _sql(
        ["register"], f"SELECT {columns} FROM register WHERE priority = 'Critical' ORDER BY problem_id"
    )
    out["issue_summary_report"] = _sql(["register"], f"SELECT {columns} FROM register ORDER BY problem_id")
    out["priority_summary"] = _sql(
        ["register"], f"SELECT priority, count(*) AS total FROM register GROUP BY priority ORDER BY {_RANK}"
    )
    out["area_summary"] = _sql(
        ["register"], "SELECT problem_area, count(*) AS total_issues FROM register GROUP BY problem_area ORDER BY total_issues DESC, 1"
    )
    out["register_with_decisions"] = _sql(
        ["register", "decisions"],
        "SELECT r.problem_id, r.problem_area, r.problem_title, r.priority, r.status, d.chosen_option, d.trade_off FROM register r "
        f"LEFT JOIN decisions d ON d.problem_id = r.problem_id ORDER BY {_RANK.replace('priority', 'r.priority')}, r.problem_id",
    )
    out["ranked_register_report"] = _sql(["register"], f"SELECT {columns} FROM register ORDER BY {_RANK}, problem_id")
    out["kpi_scoreboard"] = _sql(
        {"register": None, "legacy_customers": None, "snapshot_before": None, "snapshot_after": None, "audit": _AUDIT},
        "SELECT 'Total Problems Identified' AS item, CAST(count(*) AS VARCHAR) AS value FROM register "
        "UNION ALL SELECT 'Critical Problems', CAST(count(*) AS VARCHAR) FROM register WHERE priority = 'Critical' "
        "UNION ALL SELECT 'High Problems', CAST(count(*) AS VARCHAR) FROM register WHERE priority = 'High' "
        "UNION ALL SELECT 'Required Controls', CAST(count(*) AS VARCHAR) FROM register WHERE status = 'Required' "
        "UNION ALL SELECT 'PAN Records Tokenized', CAST(count(card_last_sixteen) AS VARCHAR) FROM legacy_customers "
        "UNION ALL SELECT 'Audit Records Generated', CAST(count(*) AS VARCHAR) FROM audit "
        "UNION ALL SELECT 'Main Recommendation', 'Fix security and recovery first'",
    )
    out["derive_log_rows"] = _sql(
        ["register"], "SELECT problem_id, 'Governance' AS control_area, 'Decision Log' AS control_name FROM register"
    )
    out["outbox_pending"] = _sql(
        ["outbox"], f"SELECT event_id, event_type, payload, {_moment('created_at')} FROM outbox WHERE NOT processed"
    )
    out["outbox_lag_alert"] = _sql(
        ["outbox"],
        "SELECT count(*) AS lag, count(*) > 1000 AS alert FROM outbox WHERE NOT processed "
        f"AND created_at < TIMESTAMP '{retail.OUTBOX_AS_OF}' - INTERVAL 5 MINUTE",
    )
    latency_parts = {
        "request_log": None,
        "stats": "SELECT name, count(*) AS total_calls, count(*) FILTER (WHERE failed) AS failures, "
        "quantile_cont(ms, 0.5) AS median_ms, quantile_cont(ms, 0.99) AS p99_ms FROM request_log WHERE name <> 'Aggregated' GROUP BY name",
    }
    latency = (
        "SELECT name, total_calls, failures, CAST(failures AS DOUBLE) / CAST(total_calls AS DOUBLE) * 100 AS failure_pct, "
        "round(CAST(median_ms AS DOUBLE), 6) AS median_ms, round(CAST(p99_ms AS DOUBLE), 6) AS p99_ms, "
        "CASE WHEN p99_ms IS NULL THEN 'UNPARSED' WHEN p99_ms > 500 THEN 'WARNING' ELSE 'PASS' END AS verdict FROM "
    )
    out["latency_sla_report"] = _sql(latency_parts, latency + "stats")
    unread = "SELECT * REPLACE (CASE WHEN name = 'error' THEN NULL ELSE p99_ms END AS p99_ms) FROM stats"
    out["latency_sla_report_csv"] = _sql(latency_parts | {"unread": unread}, latency + "unread")
    out["benchmark_metric_store"] = _sql(
        ["benchmark_runs", "benchmark_metrics"],
        "SELECT r.run_id, r.scenario_name, m.metric_name, CAST(m.metric_value AS DOUBLE) AS metric_value, m.metric_unit "
        "FROM benchmark_runs r LEFT JOIN benchmark_metrics m ON m.run_id = r.run_id",
    )

    out["retail_visits_stream"] = _sql(
        _visits("pos_events"),
        f"SELECT customer_id, store_id, {_moment('visit_start')}, {_moment('visit_end')}, transaction_count, {_amount('visit_total')} FROM visits",
    )
    last_change = "SELECT * FROM product_changes QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY change_id DESC) = 1"
    out["cdc_upsert_sync"] = _sql(
        {"product_changes": None, "search_copy": None, "latest": last_change},
        f"SELECT product_id, name, {_amount('price')} FROM search_copy WHERE product_id NOT IN (SELECT product_id FROM latest) "
        f"UNION ALL SELECT product_id, name, {_amount('price')} FROM latest WHERE op <> 'd'",
    )
    image = "'{{\"product_id\":' || product_id || ',\"name\":\"' || {0}name || '\",\"price\":' || {0}price || '}}'"
    out["audit_change_stream"] = _sql(
        {
            "product_changes": None,
            "search_copy": None,
            "steps": "SELECT c.change_id, c.product_id, c.op, c.name, c.price, b.product_id IS NOT NULL AS held, b.name AS held_name, b.price AS held_price, "
            "row_number() OVER w = 1 AS is_first, lag(c.op) OVER w AS last_op, lag(c.name) OVER w AS last_name, lag(c.price) OVER w AS last_price "
            "FROM product_changes c LEFT JOIN search_copy b ON b.product_id = c.product_id WINDOW w AS (PARTITION BY c.product_id ORDER BY c.change_id)",
            "states": "SELECT change_id, product_id, op <> 'd' AS lives, CASE WHEN is_first THEN held ELSE last_op <> 'd' END AS lived, name, price, "
            "CASE WHEN is_first THEN held_name ELSE last_name END AS old_name, CASE WHEN is_first THEN held_price ELSE last_price END AS old_price FROM steps",
        },
        "SELECT 'products' AS table_name, CASE WHEN NOT lived THEN 'INSERT' WHEN NOT lives THEN 'DELETE' ELSE 'UPDATE' END AS action_name, "
        f"CAST(product_id AS VARCHAR) AS record_id, CASE WHEN lived THEN {image.format('old_')} END AS old_data, "
        f"CASE WHEN lives THEN {image.format('')} END AS new_data, change_id FROM states "
        "WHERE lived <> lives OR (lives AND (name IS DISTINCT FROM old_name OR price IS DISTINCT FROM old_price))",
    )
    out["outbox_lag_stream"] = out["outbox_lag_alert"]
    digest = "sha1(unhex('{0}') || CAST({1} AS BLOB))"
    named = (
        "left({0}, 8) || '-' || substr({0}, 9, 4) || '-5' || substr({0}, 14, 3) || '-' || "
        "substr('89ab', CAST(CAST('0x' || substr({0}, 17, 1) AS INTEGER) % 4 + 1 AS INTEGER), 1) || substr({0}, 18, 3) || '-' || substr({0}, 21, 12)"
    )
    steps = ", ".join(f"('{step}', '{node}')" for step, node in delivery.STEPS.items())
    out["outbox_delivery"] = _sql(
        {
            "saga_orders": None,
            "steps": f"SELECT * FROM (VALUES {steps}) AS s(event_type, destination)",
            "hashed": f"SELECT {digest.format(delivery.SAGAS.hex, 'concat(order_id, chr(58), event_type)')} AS e, "
            f"{digest.format(delivery.SAGAS.hex, 'CAST(order_id AS VARCHAR)')} AS g, * FROM "
            "(SELECT DISTINCT order_id, created_at FROM saga_orders) o CROSS JOIN steps",
        },
        f"SELECT {named.format('e')} AS event_id, {named.format('g')} AS saga_id, event_type, destination, "
        f"'{{\"order_id\":' || order_id || '}}' AS payload, {_moment('created_at')} FROM hashed",
    )
    out["stock_reserve_stream"] = _sql(
        {
            "stream_requests": None,
            "numbered": "SELECT *, row_number() OVER (PARTITION BY store_id, product_id ORDER BY request_id) AS n FROM stream_requests",
            "replay": f"SELECT n, store_id, product_id, request_id, qty, qty <= {catalog.SHELF_STOCK} AS ok, "
            f"{catalog.SHELF_STOCK} - CASE WHEN qty <= {catalog.SHELF_STOCK} THEN qty ELSE 0 END AS left_over FROM numbered WHERE n = 1 "
            "UNION ALL SELECT r.n, r.store_id, r.product_id, r.request_id, r.qty, r.qty <= p.left_over, "
            "p.left_over - CASE WHEN r.qty <= p.left_over THEN r.qty ELSE 0 END FROM replay p JOIN numbered r "
            "ON r.store_id = p.store_id AND r.product_id = p.product_id AND r.n = p.n + 1",
        },
        "SELECT request_id, store_id, product_id, qty, CASE WHEN ok THEN 'ACCEPTED' ELSE 'REFUSED' END AS outcome, "
        "left_over AS stock_after FROM replay",
        recursive=True,
    )
    out["credit_adjust_stream"] = out["credit_adjust_versioned"]
    return out
