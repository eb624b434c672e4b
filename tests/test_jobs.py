from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.operators import audit, dimensions, facts, quality, serving
from ledgerloom.plans import jobs
from ledgerloom.sources import tables

OPEN = date(9999, 12, 31)
DIM = (
    "customer_key long, customer_id long, first_name string, last_name string, email string, city string, province string, "
    "effective_from date, effective_to date, is_current boolean"
)


def sources(spark, statuses):
    orders = spark.createDataFrame(
        [(i, 1, datetime(2024, i, 2), 1, "retail", s) for i, s in statuses.items()],
        "order_id long, customer_id long, order_date timestamp_ntz, store_id int, channel string, status string",
    ).withColumns({"ship_date": F.col("order_date"), "payment_received_date": F.to_date("order_date")})
    items = spark.createDataFrame([(i, 7, 2, Decimal("10.00")) for i in statuses], "order_id long, product_id long, qty int, unit_price decimal(18,2)")
    refunds = spark.createDataFrame([(1, Decimal("1.00"))], "order_id long, refund_amount decimal(18,2)")
    bridge = spark.createDataFrame([(1, 5)], "order_id long, promotion_id long")
    promotions = spark.createDataFrame([(5, Decimal("0.50"))], "promotion_id long, discount_amount decimal(18,2)")
    return jobs.Sources(orders, items, refunds, bridge, promotions)


def test_nightly_load_is_incremental_and_verified(spark, tmp_path):
    dim = spark.createDataFrame([(1, 1, "f", "l", "e", "c", "p", date(2000, 1, 1), OPEN, True)], DIM)
    calendar = dimensions.calendar_dim(spark, date(2024, 1, 1), date(2024, 12, 31))
    stores = spark.createDataFrame([(1, 11)], "store_id int, store_key int")
    path = str(tmp_path / "fact")
    first = sources(spark, {1: "completed", 2: "completed"})
    fact = jobs.load_sales_fact(first, dim, calendar, stores, path)
    assert {r.order_id: r.net_revenue for r in fact.collect()} == {1: Decimal("18.50"), 2: Decimal("20.00")}
    # Order 2 is cancelled late, order 3 is new.
    second = sources(spark, {1: "completed", 2: "cancelled", 3: "completed"})
    fact = jobs.load_sales_fact(second, dim, calendar, stores, path)
    assert sorted(r.order_id for r in fact.collect()) == [1, 2, 3]
    again = jobs.load_sales_fact(second, dim, calendar, stores, path)
    assert again.count() == 3
    verdicts = {r.verdict: r.orders for r in jobs.verify_load(again, second).collect()}
    assert verdicts == {"MATCH": 2, "MISSING_IN_SOURCE": 1}
    month = again.filter("order_month = '2024-03'")
    assert "PartitionFilters: [isnotnull(order_month" in month._jdf.queryExecution().executedPlan().toString()


def test_customer_dim_gets_keys(spark, tmp_path):
    dim = spark.createDataFrame(
        [(40, 1, "f", "l", "e", "A", "p", date(2000, 1, 1), OPEN, True), (41, 2, "f", "l", "e", "A", "p", date(2000, 1, 1), OPEN, True)], DIM
    )
    staging = spark.createDataFrame(
        [(1, "f", "l", "e", "B", "p", 1), (2, "f", "l", "e", "A", "p", 1), (3, "f", "l", "e", "A", "p", 1)],
        "customer_id long, first_name string, last_name string, email string, city string, province string, n int",
    )
    result = jobs.refresh_customer_dim(dim, staging, date(2024, 1, 1), str(tmp_path), ["n"]).collect()
    keys = [r.customer_key for r in result]
    assert len(result) == 4 and len(set(keys)) == 4 and min(k for k in keys if k > 41) > 41


def test_snapshots_of_a_day(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    stock = spark.createDataFrame([(1, 1, 10), (2, 1, 20)], "product_id int, store_id int, quantity_available int")
    later = stock.withColumn("quantity_available", F.col("quantity_available") - 5)
    jobs.record_snapshot(stock, datetime(2024, 2, 1, 10), path)
    jobs.record_snapshot(later, datetime(2024, 2, 1, 14), path)
    table = jobs.record_snapshot(later, datetime(2024, 2, 1, 14), path)
    assert sorted((r.slot, r.product_id, r.quantity_on_hand) for r in table.collect()) == [
        ("1000", 1, 10), ("1000", 2, 20), ("1400", 1, 5), ("1400", 2, 15),
    ]


def test_null_keys_in_the_target_do_not_hide_new_orders(spark):
    candidates = spark.createDataFrame([(1,), (2,), (None,)], "order_id long")
    loaded = spark.createDataFrame([(1,), (None,)], "order_id long")
    assert {r.order_id for r in facts.not_yet_loaded(candidates, loaded).collect()} == {2, None}


def test_shards_are_merged_and_clashes_named(spark, tmp_path):
    for name, rows in {"a": [(1, "Ali"), (2, "Mir")], "b": [(2, "Noor"), (3, "Zia")]}.items():
        spark.createDataFrame(rows, "customer_id int, last_name string").write.parquet(str(tmp_path / name))
    shards = [tables.read_parquet(spark, str(tmp_path / name)) for name in "ab"]
    merged, clashes = quality.consolidate_shards(shards, "customer_id")
    assert merged.count() == 4
    assert [(r.customer_id, r.copies) for r in clashes.collect()] == [(2, 2)]


def test_remediation_in_order(spark, tmp_path):
    products = spark.createDataFrame(
        [(1, "digital", 3.0, "plain"), (2, "physical", 4.0, '{"a":1}'), (3, "logistics", None, "{bad")],
        "product_id int, product_type string, weight_kg double, description string",
    )
    customers = spark.createDataFrame(
        [(1, "A", "a@x", "4" * 16, '{"p":1}'), (2, "B", "b@x", None, "{oops"), (3, "C", "c@x", "3" * 15, None)],
        "customer_id long, full_name string, email string, card_last_sixteen string, profile_data string",
    )
    plans = spark.createDataFrame([(1, 1), (2, 77), (3, None)], "plan_id int, customer_id long")
    orders = spark.createDataFrame([(1, date(2024, 1, 1))], "customer_id long, order_date date")
    done = jobs.remediate_all(
        products, customers, plans, orders, as_of=datetime(2024, 6, 1), key=F.unhex(F.md5(F.lit("k"))), name="Holding", email="h@x", root=str(tmp_path)
    )
    assert {r["item"]: r.value for r in done["scoreboard"].collect()} == {
        "invalid_product_weights": 0,
        "populated_product_descriptions": 3,
        "pan_rows_remaining_in_customers": 0,
        "customers_with_json_profiles": 1,
        "pan_rows_in_vault": 2,
        "malformed_profiles_deadlettered": 1,
    }
    assert done["broken_references"].isEmpty()
    assert {r.plan_id: r.customer_id for r in done["plans"].collect()} == {1: 1, 2: -1, 3: None}


def test_stored_view_is_replaced(spark):
    reviews = spark.createDataFrame([(1, 4), (1, 5), (2, None)], "product_id int, rating int")
    try:
        view = tables.store_view(serving.product_ratings(reviews), "ratings_view")
        assert {(r.product_id, r.avg_rating, r.review_count) for r in view.collect()} == {(1, 4.5, 2), (2, None, 0)}
        refreshed = tables.store_view(serving.product_ratings(reviews.filter("product_id = 1")), "ratings_view")
        # A plan that reads the refresh before goes on; the name shows the new one.
        assert view.count() == 2 and refreshed.count() == 1 and spark.table("ratings_view").count() == 1
        tables.drop_refreshes(spark, "ratings_view", refreshed)
        assert spark.table("ratings_view").count() == 1
        assert sum(t.name.startswith("ratings_view_") for t in spark.catalog.listTables()) == 1
    finally:
        tables.drop_refreshes(spark, "ratings_view")


def test_audit_stamps(spark):
    before = spark.createDataFrame([(1, "a")], "customer_id int, v string")
    after = spark.createDataFrame([(1, "b")], "customer_id int, v string")
    row = audit.change_log(before, after, "customer_id", "t", changed_by="me", changed_at=datetime(2024, 1, 1)).first()
    assert (row.changed_by, row.changed_at) == ("me", datetime(2024, 1, 1))


def test_changed_orders_are_repaired_in_their_months_alone(spark, tmp_path):
    dim = spark.createDataFrame([(1, 1, "f", "l", "e", "c", "p", date(2000, 1, 1), OPEN, True)], DIM)
    calendar = dimensions.calendar_dim(spark, date(2024, 1, 1), date(2024, 12, 31))
    dims = (dim, calendar, spark.createDataFrame([(1, 11)], "store_id int, store_key int"))
    path = tmp_path / "fact"
    loaded = sources(spark, {i: "completed" for i in range(1, 7)})
    jobs.load_sales_fact(loaded, *dims, str(path))
    files = lambda: {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    before = files()
    # Order 2 is cancelled, order 4 priced anew, order 7 is new; order 5 changed before the last night.
    now = sources(spark, {1: "completed", 2: "cancelled", **{i: "completed" for i in range(3, 8)}})
    dearer = now.items.withColumn("unit_price", F.when(F.col("order_id") == 4, F.lit(Decimal("11.00"))).otherwise(F.col("unit_price")))
    now = jobs.Sources(now.orders, dearer, now.refunds, now.order_promotions, now.promotions)
    changes = spark.createDataFrame([(2, datetime(2024, 2, 2), date(2024, 8, 1)), (4, datetime(2024, 4, 2), date(2024, 8, 1)), (5, datetime(2024, 5, 2), date(2024, 7, 1))], "order_id long, order_date timestamp_ntz, changed_on date")
    verdicts = {r.verdict: (r.orders, r.difference) for r in jobs.nightly_sales(now, changes, date(2024, 7, 31), *dims, str(path)).collect()}
    assert verdicts == {"MATCH": (6, 0)}
    after = files()
    untouched = {f for f in before if f.parent.name not in ("order_month=2024-02", "order_month=2024-04")}
    assert {f: after[f] for f in untouched} == {f: before[f] for f in untouched}
    # February has no order left, so its folder is gone.
    assert sorted(p.name for p in path.glob("order_month=*")) == [f"order_month=2024-0{m}" for m in (1, 3, 4, 5, 6, 7)]
    assert jobs.repair_stored_fact(now, changes, date(2024, 7, 31), *dims, str(path)) == ["2024-02", "2024-04"]
    assert jobs.verify_load(tables.read_parquet(spark, str(path)), now).filter("verdict <> 'MATCH'").isEmpty()


def test_repair_reads_the_months_of_the_changes(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(1000).selectExpr("id AS order_id", "id AS amount", "concat('2024-', lpad(id % 12 + 1, 2, '0')) AS order_month").write.partitionBy("order_month").parquet(path)
    spark.createDataFrame([(5, "2024-06", date(2024, 8, 1))], "order_id long, order_month string, changed_on date").write.parquet(str(tmp_path / "changes"))
    changes = spark.read.parquet(str(tmp_path / "changes")).filter("changed_on >= DATE '2024-07-01'")
    months = jobs.touched_months(spark.read.parquet(path), changes)
    assert months.count() == sum(i % 12 == 5 for i in range(1000))
    assert "dynamicpruning" in months._jdf.queryExecution().executedPlan().toString().lower()


def test_loading_reads_the_months_of_the_nights_orders(spark, tmp_path):
    path = str(tmp_path / "fact")
    spark.range(100).selectExpr("id AS order_id", "concat('2024-', lpad(id % 12 + 1, 2, '0')) AS order_month").write.partitionBy("order_month").parquet(path)
    night = spark.createDataFrame([(1, datetime(2024, 2, 1)), (500, datetime(2024, 3, 1))], "order_id long, order_date timestamp_ntz")
    ids = jobs._loaded_ids(night, spark.read.parquet(path))
    plan = ids._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [order_month" in plan and "IN (2024-02,2024-03)" in plan
    assert {r[0] for r in ids.collect()} == {i for i in range(100) if i % 12 in (1, 2)}


def test_figures_are_taken_as_the_table_is_written(spark, tmp_path):
    rows = spark.range(1000).selectExpr("id", "IF(id % 3 = 0, NULL, id) AS v")
    spark.sparkContext.setJobGroup("counted", "one pass")
    stored, figures = quality.write_counted(rows, str(tmp_path / "t"), {**quality.broken({"present": F.col("v").isNotNull(), "small": F.col("v") < 500}), "rows": F.count("*")})
    jobs_run = spark.sparkContext.statusTracker().getJobIdsForGroup("counted")
    spark.sparkContext._jsc.clearJobGroup()
    assert figures == {"present": 334, "small": 333, "rows": 1000} and stored.count() == 1000
    assert len(jobs_run) == 1


def test_contact_function_joins_and_pushes_its_filter(spark, tmp_path):
    people = [(i, f"n{i}", f"e{i}", None, "card") for i in range(50)]
    spark.createDataFrame(people, "customer_id long, full_name string, email string, phone string, card string").write.parquet(str(tmp_path / "c"))
    name = serving.register_contact_function(spark.read.parquet(str(tmp_path / "c")), "contact_for_test")
    asked = spark.createDataFrame([(1, 7), (2, 99), (3, None), (4, 7)], "request_id int, customer_id long")
    found = serving.contacts_of(asked, name)
    assert {(r.request_id, r.full_name) for r in found.collect()} == {(1, "n7"), (2, None), (3, None), (4, "n7")}
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "card" not in plan
    single = spark.sql(f"SELECT * FROM {name}(7)")
    assert "EqualTo(customer_id,7)" in single._jdf.queryExecution().executedPlan().toString()
    assert single.first().email == "e7"
