import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators import audit, credit, inventory, layout, monitoring, privacy, reports
from ledgerloom.sources import tables


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_one_store_reads_one_folder(spark, tmp_path):
    rows = spark.range(200).select((F.col("id") % 20).cast("int").alias("store_id"), F.col("id").alias("product_id"))
    table = layout.write_by_list(rows, str(tmp_path / "inv"), "store_id")
    one = layout.read_one(table, "store_id", 7)
    assert "PartitionFilters: [isnotnull(store_id" in plan_of(one)
    assert {r.store_id for r in one.collect()} == {7} and one.count() == 10
    assert len([p for p in (tmp_path / "inv").iterdir() if p.name.startswith("store_id=")]) == 20


def test_months_archive_and_overflow(spark, tmp_path):
    days = [date(2025, 6, 30), date(2025, 7, 1), date(2025, 12, 31), date(2026, 6, 30), date(2026, 7, 1)]
    rows = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id int, order_date date")
    table = layout.write_by_month(rows, str(tmp_path / "orders"), "order_date")
    labels = {r.id: r.order_month for r in table.collect()}
    assert [labels[i] for i in range(5)] == ["archive", "2025-07", "2025-12", "2026-06", "overflow"]
    assert "PartitionFilters: [isnotnull(order_month" in plan_of(layout.read_one(table, "order_month", "2025-12"))


def test_backfill_only_when_empty(spark, tmp_path):
    rows = spark.createDataFrame([(1, 5), (2, 6)], "store_id int, stock int")
    empty = spark.createDataFrame([], rows.schema)
    filled = layout.backfill_if_empty(empty, rows, str(tmp_path / "a"), "store_id")
    assert filled.count() == 2
    assert layout.backfill_if_empty(filled, rows.union(rows), str(tmp_path / "b"), "store_id").count() == 2
    assert not (tmp_path / "b").exists()


def test_bucketed_tables_join_without_shuffle(spark, tmp_path):
    rows = spark.range(100).select(F.col("id").alias("customer_id"), F.lit(1).alias("x"))
    left = layout.write_bucketed(rows, "bucketed_left", str(tmp_path / "l"), "customer_id")
    right = layout.write_bucketed(rows, "bucketed_right", str(tmp_path / "r"), "customer_id")
    try:
        joined = left.join(right.hint("merge"), "customer_id")
        assert "Exchange" not in plan_of(joined)
        assert joined.count() == 100
    finally:
        spark.sql("DROP TABLE bucketed_left")
        spark.sql("DROP TABLE bucketed_right")


def test_hash_bucket_covers_all_rows(spark):
    counts = layout.hash_partition_counts(spark.range(1000).withColumnRenamed("id", "k"), "k").collect()
    assert sum(r.rows for r in counts) == 1000 and {r.bucket for r in counts} <= set(range(8))


def test_sla_report_from_csv(spark, tmp_path):
    (tmp_path / "stats.csv").write_text(
        "Type,Name,Request Count,Failure Count,Median Response Time,99%\n"
        "q,Search,100,2,40,500\nq,Checkout,50,0,60,501\nq,Idle,0,0,0,0\nq,Broken,5,1,10,n/a\nq,,1,0,1,1\nq,Aggregated,155,3,50,501\n"
    )
    rows = {r.name: r for r in monitoring.latency_report_from_stats(tables.read_load_stats(spark, str(tmp_path / "stats.csv"))).collect()}
    assert {n: r.verdict for n, r in rows.items()} == {
        "Search": "PASS", "Checkout": "WARNING", "Idle": "PASS", "Broken": "UNPARSED", "Unknown": "PASS",
    }
    assert rows["Search"].failure_pct == pytest.approx(2.0) and rows["Idle"].failure_pct is None


def test_latency_report_counts_repeated_values(spark):
    rng = random.Random(1)
    values = [rng.randrange(30) for _ in range(501)]
    log = spark.createDataFrame([("a", v, v == 3) for v in values], "name string, ms int, failed boolean")
    row = monitoring.latency_report(log).first()
    assert row.total_calls == 501 and row.failures == values.count(3)
    assert row.median_ms == sorted(values)[250] and row.p99_ms == sorted(values)[495]


def test_outbox_lag_is_strictly_older(spark):
    now = datetime(2024, 1, 1, 12)
    rows = [(1, False, now - timedelta(minutes=5)), (2, False, now - timedelta(minutes=5, microseconds=1)), (3, True, now - timedelta(days=1))]
    outbox = spark.createDataFrame(rows, "event_id int, processed boolean, created_at timestamp_ntz")
    lag = monitoring.outbox_lag(outbox, now, threshold=0)
    assert (lag.first().lag, lag.first().alert) == (1, True)
    assert not monitoring.outbox_lag(outbox, now).first().alert


def test_plan_rules_are_ordered(spark):
    as_of, late, early = date(2024, 6, 1), date(2024, 5, 1), date(2023, 1, 1)
    rows = [
        (1, 1, 3, None, early, as_of, "active"),  # missed and reversed: missed wins
        (2, 1, 3, early, late, None, "active"),  # restructured and paying, though payments were missed
        (3, 1, 3, early, early, None, "active"),
        (4, 1, 0, None, early, as_of, "active"),
        (5, 99, 0, None, early, None, "active"),
        (6, 99, 3, None, early, None, "active"),  # a default stays one without a customer
        (7, 1, 0, early, date(2024, 4, 1), None, "completed"),
        (8, None, 0, None, None, None, "active"),
    ]
    plans = spark.createDataFrame(
        [(i, c, m, 3, r, p, v, s) for i, c, m, r, p, v, s in rows],
        "plan_id int, customer_id long, missed_payment_count int, default_threshold int, restructure_date date, "
        "last_payment_date date, reversal_date date, current_status string",
    )
    customers = spark.createDataFrame([(1,)], "customer_id long")
    classified = credit.reclassify_plans(plans, customers, as_of)
    got = {r.plan_id: r.status_category for r in classified.collect()}
    assert got == {1: "defaulted", 2: "restructured", 3: "restructured_default", 4: "reversed", 5: "orphan", 6: "defaulted", 7: "restructured", 8: "orphan"}
    rate = credit.plan_default_rate(classified, credit.plan_status_dim(spark)).first()
    assert (rate.defaults, rate.total_plans) == (3, 5)


def test_vault_retention_boundary_and_upsert(spark):
    key = F.unhex(F.md5(F.lit("k")))
    customers = spark.createDataFrame([(1, "4" * 16), (2, "3" * 15), (3, None)], "customer_id long, card_last_sixteen string")
    orders = spark.createDataFrame([(1, date(2022, 12, 1)), (2, date(2022, 11, 30)), (1, date(2024, 1, 1))], "customer_id long, order_date date")
    vault = privacy.vault_pans(customers, orders, date(2024, 6, 1), key)
    assert {r.customer_id: r.retention_state for r in vault.collect()} == {1: "active", 2: "expired"}
    again = privacy.upsert(vault, privacy.vault_pans(customers, orders, date(2024, 6, 1), key), ["customer_id"])
    assert again.count() == 2
    assert privacy.tokenize_pans(customers, "salt").filter("length(pan_token) = 68").count() == 2


def test_audit_logs_null_changes_only_once(spark):
    before = spark.createDataFrame([(1, None), (2, "x"), (3, "y")], "customer_id int, v string")
    after = spark.createDataFrame([(1, None), (2, None), (4, "z")], "customer_id int, v string")
    log = {r.record_id: r for r in audit.change_log(before, after, "customer_id", "t").collect()}
    assert {k: r.action_name for k, r in log.items()} == {"2": "UPDATE", "3": "DELETE", "4": "INSERT"}
    assert log["2"].new_data == '{"customer_id":2,"v":null}' and log["3"].new_data is None


def test_event_only_with_findings(spark):
    assert audit.event_if_any(spark.range(0), "T", "d", "s").isEmpty()
    assert audit.event_if_any(spark.range(5), "T", "d", "s").count() == 1


def test_priority_order_and_literal_rows(spark):
    register = spark.createDataFrame([(1, "Low"), (2, "High"), (3, "Critical"), (4, "Odd"), (5, "High")], "problem_id int, priority string")
    assert [r.priority for r in reports.priority_summary(register).collect()] == ["Critical", "High", "Low", "Odd"]
    assert [r.problem_id for r in reports.ranked_register(register, ["problem_id"]).collect()] == [3, 2, 5, 1, 4]
    actions = reports.literal_rows(spark, [(1, "first"), (2, "second")], "priority_no int, action string")
    assert [tuple(r) for r in actions.collect()] == [(1, "first"), (2, "second")]


def test_snapshot_is_stamped(spark):
    stock = spark.createDataFrame([(1, 2, 3)], "product_id int, store_id int, quantity_available int")
    row = inventory.capture_snapshot(stock, datetime(2024, 2, 1, 22, 0)).first()
    assert (row.quantity_on_hand, row.snapshot_time, row.snapshot_date) == (3, datetime(2024, 2, 1, 22), date(2024, 2, 1))


def test_scratch_is_released_but_for_what_is_kept(spark):
    from pathlib import Path

    from ledgerloom.session import cut_lineage, released_scratch

    folder = lambda df: Path(df.inputFiles()[0].removeprefix("file://")).parent
    with released_scratch(spark) as keep:
        step = cut_lineage(spark.range(5))
        with released_scratch(spark) as keep_inside:
            inner = keep_inside(cut_lineage(step.filter("id > 1")))
        kept, gone = keep(inner.filter("id > 2")), [folder(step), folder(inner)]
    assert kept.count() == 2 and folder(kept).exists()
    assert not any(path.exists() for path in gone)
    after = cut_lineage(kept)
    assert folder(after).exists() and after.count() == 2
