from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators import dimensions, facts

DIM = (
    "customer_key long, customer_id long, first_name string, last_name string, email string, city string, province string, "
    "effective_from date, effective_to date, is_current boolean"
)
STAGING = "customer_id long, first_name string, last_name string, email string, city string, province string, loaded_at int"
OPEN = date(9999, 12, 31)
TODAY = date(2024, 5, 1)


def person(key, customer, city, province, start, end=OPEN, current=True):
    return (key, customer, "f", "l", "e", city, province, start, end, current)


def staged(customer, city, province, loaded_at=1):
    return (customer, "f", "l", "e", city, province, loaded_at)


def load(spark):
    old = date(2020, 1, 1)
    dim = spark.createDataFrame(
        [
            person(1, 1, "A", "P", old),  # unchanged
            person(2, 2, "A", "P", old),  # city changes
            person(3, 3, None, "P", old),  # null becomes a value
            person(4, 4, "A", "P", old),  # value becomes null
            person(5, 5, "A", "P", old),  # not staged
            person(6, 6, "A", "P", old, date(2022, 1, 1), False),
            person(7, 6, "B", "P", date(2022, 1, 1)),  # history, province changes
            person(8, 7, "A", "P", old, date(2021, 1, 1), False),  # closed long ago, stays closed
            person(9, 9, None, None, old),  # null stays null
        ],
        DIM,
    )
    staging = spark.createDataFrame(
        [
            staged(1, "A", "P"),
            staged(2, "B", "P"),
            staged(2, "C", "P", 2),
            staged(3, "A", "P"),
            staged(4, None, "P"),
            staged(6, "B", "Q"),
            staged(7, "Z", "P"),
            staged(8, "N", "P"),
            staged(9, None, None),
        ],
        STAGING,
    )
    return dim, staging


def test_apply_changes(spark):
    dim, staging = load(spark)
    result = dimensions.apply_scd2_changes(dim, staging, TODAY, ["loaded_at"])
    current = {r.customer_id: r for r in result.filter("is_current").collect()}
    assert {k: (r.city, r.province) for k, r in current.items()} == {
        1: ("A", "P"), 2: ("C", "P"), 3: ("A", "P"), 4: (None, "P"), 5: ("A", "P"), 6: ("B", "Q"), 8: ("N", "P"), 9: (None, None),
    }
    assert {k for k, r in current.items() if r.customer_key is None} == {2, 3, 4, 6, 8}
    assert all(r.effective_to == OPEN for r in current.values())
    closed = {(r.customer_key, r.effective_to) for r in result.filter("not is_current").collect()}
    assert closed == {(2, TODAY), (3, TODAY), (4, TODAY), (6, date(2022, 1, 1)), (7, TODAY), (8, date(2021, 1, 1))}


def test_apply_changes_twice_is_once(spark):
    dim, staging = load(spark)
    once = dimensions.apply_scd2_changes(dim, staging, TODAY, ["loaded_at"])
    twice = dimensions.apply_scd2_changes(once, staging, TODAY, ["loaded_at"])
    assert once.exceptAll(twice).isEmpty() and twice.exceptAll(once).isEmpty()


def test_versions_do_not_overlap(spark):
    dim, staging = load(spark)
    result = dimensions.apply_scd2_changes(dim, staging, TODAY, ["loaded_at"]).withColumn("id", F.monotonically_increasing_id())
    a, b = result.alias("a"), result.alias("b")
    overlap = a.join(
        b,
        (F.col("a.customer_id") == F.col("b.customer_id"))
        & (F.col("a.id") < F.col("b.id"))
        & (F.col("a.effective_from") < F.col("b.effective_to"))
        & (F.col("b.effective_from") < F.col("a.effective_to")),
    )
    assert overlap.isEmpty()


def test_change_day_belongs_to_the_new_version(spark):
    versions = spark.createDataFrame(
        [(1, 1, date(2020, 1, 1), TODAY), (2, 1, TODAY, OPEN)],
        "customer_key long, customer_id long, effective_from date, effective_to date",
    )
    orders = spark.createDataFrame([(10, 1, datetime(2024, 5, 1, 13))], "order_id long, customer_id long, order_date timestamp_ntz")
    exact = facts.as_of_version(orders, versions, "customer_id", "order_date").collect()
    assert [r.customer_key for r in exact] == [2]
    both = facts.as_of_version(orders, versions, "customer_id", "order_date", inclusive_end=True)
    assert both.count() == 2


def test_backfill(spark):
    dim = spark.createDataFrame([(1, "x"), (2, "y")], "customer_key long, city string")
    fact = spark.createDataFrame([(1, datetime(2024, 2, 3, 9)), (1, datetime(2024, 1, 2, 9))], "customer_key long, order_date timestamp_ntz")
    rows = {r.customer_key: r for r in dimensions.backfill_validity(dim, fact).collect()}
    assert rows[1].effective_from == date(2024, 1, 2)
    assert rows[2].effective_from == date(2023, 1, 1)
    assert rows[1].is_current and rows[1].effective_to == OPEN


def test_net_revenue_identity_and_incremental_load(spark):
    orders = spark.createDataFrame(
        [
            (1, 1, datetime(2024, 1, 1), 1, "retail", "completed"),
            (2, 1, datetime(2024, 1, 2), 1, "retail", "cancelled_fraud"),
            (3, 1, datetime(2024, 1, 3), 1, "online", "completed"),
            (4, 1, datetime(2024, 1, 3), 1, "online", None),
        ],
        "order_id long, customer_id long, order_date timestamp_ntz, store_id int, channel string, status string",
    ).withColumns({"ship_date": F.col("order_date"), "payment_received_date": F.lit(date(2024, 3, 31))})
    items = spark.createDataFrame(
        [(1, 2, Decimal("10.00")), (1, 1, Decimal("5.50")), (2, 1, Decimal(9)), (3, 1, Decimal(7)), (4, 1, Decimal(3))],
        "order_id long, qty int, unit_price decimal(18,2)",
    )
    refunds = spark.createDataFrame([(1, Decimal("1.25"))], "order_id long, refund_amount decimal(18,2)")
    bridge = spark.createDataFrame([(1, 100), (1, 100), (3, 101)], "order_id long, promotion_id long")
    promotions = spark.createDataFrame([(100, Decimal("0.50"))], "promotion_id long, discount_amount decimal(18,2)")
    versions = spark.createDataFrame(
        [(7, 1, date(2000, 1, 1), OPEN)], "customer_key long, customer_id long, effective_from date, effective_to date"
    )
    calendar = dimensions.calendar_dim(spark, date(2024, 1, 1), date(2024, 1, 31))
    stores = spark.createDataFrame([(1, 11)], "store_id int, store_key int")
    args = (orders, items, refunds, bridge, promotions, versions, calendar, stores)
    fact = facts.net_revenue_fact(*args)
    rows = {r.order_id: r for r in fact.collect()}
    assert set(rows) == {1, 3}
    assert rows[1].net_revenue == Decimal("23.25") and rows[3].net_revenue == Decimal(7)
    assert all(r.net_revenue == r.gross_revenue - r.refund_amount - r.discount_amount for r in rows.values())
    loaded = fact.filter("order_id = 1").select("order_id")
    assert [r.order_id for r in facts.net_revenue_fact(*args, loaded).collect()] == [3]
    paid = facts.with_payment_time_key(fact, calendar)
    assert [r.payment_time_key for r in paid.collect()] == [None, None]
