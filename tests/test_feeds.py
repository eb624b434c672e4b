import random
from datetime import datetime
from decimal import Decimal

from pyspark.sql import Row

from ledgerloom.operators import folds
from ledgerloom.streaming import changes, feeds, ledger

CHANGE = "change_id int, product_id int, op string, name string"


def land(spark, path, batches, schema):
    """One file per batch, stored in order, and a stream that takes one file at a time."""
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(path))
    table = spark.read.parquet(str(path))
    return feeds.follow_parquet(spark, str(path), table.schema, max_files=1)


def test_change_sync_over_batches(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "product_id int, name string")
    batches = [
        [(1, 1, "u", "a1"), (2, 4, "c", "d"), (3, 1, "u", "a2")],
        [(4, 2, "d", None), (5, 4, "u", "d2")],
        [(6, 2, "c", "b again"), (7, 3, "d", None)],
    ]
    stream = land(spark, tmp_path / "feed", batches, CHANGE)
    out, ckpt = str(tmp_path / "out"), str(tmp_path / "ckpt")
    feeds.drain(stream, changes.record_changes(out, "product_id", ["change_id"]), ckpt)
    stored = changes.read_changes(base, out, stream.schema)
    assert {r.batch_id for r in stored.select("batch_id").distinct().collect()} == {0, 1, 2}
    copy = changes.current_copy(base, stored, "product_id", ["change_id"])
    assert {tuple(r) for r in copy.collect()} == {(1, "a2"), (2, "b again"), (4, "d2")}
    compacted = changes.compact(base, stored, "product_id", ["change_id"], str(tmp_path / "base2"))
    assert {tuple(r) for r in compacted.collect()} == {(1, "a2"), (2, "b again"), (4, "d2")}
    # Nothing new: a second run adds no batch.
    feeds.drain(stream, changes.record_changes(out, "product_id", ["change_id"]), ckpt)
    assert changes.read_changes(base, out, stream.schema).count() == stored.count()


def test_audit_over_batches(spark, tmp_path):
    base = spark.createDataFrame([(1, "a"), (2, "b")], "product_id int, name string")
    batches = [[(1, 1, "u", "a1"), (2, 3, "c", "c")], [(3, 1, "u", "a1"), (4, 2, "d", None), (5, 3, "u", "c2")]]
    stream = land(spark, tmp_path / "feed", batches, CHANGE)
    handler = changes.record_audit(
        base, str(tmp_path / "changes"), str(tmp_path / "log"), "product_id", ["change_id"], "products", stream.schema
    )
    feeds.drain(stream, handler, str(tmp_path / "ckpt"))
    log = spark.read.parquet(str(tmp_path / "log")).collect()
    got = {(r.change_id, r.record_id, r.action_name, r.old_data, r.new_data) for r in log}
    assert got == {
        (1, "1", "UPDATE", '{"product_id":1,"name":"a"}', '{"product_id":1,"name":"a1"}'),
        (2, "3", "INSERT", None, '{"product_id":3,"name":"c"}'),
        (4, "2", "DELETE", '{"product_id":2,"name":"b"}', None),
        (5, "3", "UPDATE", '{"product_id":3,"name":"c"}', '{"product_id":3,"name":"c2"}'),
    }


def test_audit_does_not_depend_on_batches_and_reads_a_bounded_number_of_folders(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(changes, "ABSORB_EVERY", 3)
    monkeypatch.setattr(changes, "RUN_LENGTH", 4)
    rng = random.Random(8)
    rows = [(i, rng.randrange(3), rng.choice("uuud"), rng.choice("xyz")) for i in range(40)]
    base = spark.createDataFrame([(0, "a"), (1, "x")], "product_id int, name string")
    logs, folders = [], []
    for size in (40, 5):
        parts = [rows[i : i + size] for i in range(0, len(rows), size)]
        where = str(tmp_path / str(size))
        handle = changes.record_audit(base, f"{where}/changes", f"{where}/log", "product_id", ["change_id"], "products", spark.createDataFrame(rows[:1], CHANGE).schema)
        for number, part in enumerate(parts):
            handle(spark.createDataFrame(part, CHANGE), number)
            folders.append(len(changes.child_names(spark, f"{where}/changes")))
        logs.append(sorted(tuple(r) for r in spark.read.parquet(f"{where}/log").drop("batch_id").select("change_id", "action_name").collect()))
    assert logs[0] == logs[1] and len(logs[0]) > 15
    assert max(folders) <= 4


def test_a_processed_event_stays_processed(spark, tmp_path):
    schema = "event_id long, created_at timestamp_ntz, processed boolean"
    as_of = datetime(2024, 1, 1, 12)
    row = lambda processed: spark.createDataFrame([(1, datetime(2024, 1, 1, 10), processed)], schema)
    handle = changes.watch_outbox(str(tmp_path / "state"), str(tmp_path / "lag"), lambda _: as_of, row(True).schema)
    for number, processed in enumerate([True, False, False, False]):
        handle(row(processed), number)
    assert {r.lag for r in spark.read.parquet(str(tmp_path / "lag")).collect()} == {0}
    assert changes.child_names(spark, str(tmp_path / "state")) == ["v2", "v3"]


def test_reservation_feed_equals_batch(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice([1, 1, 2, None]), rng.randrange(4), rng.choice([None, -2, 1, 2, 3, 4, 5, 6])) for i in range(90)]
    schema = "request_id int, store_id int, product_id int, qty int"
    shelf = spark.createDataFrame([(s, p, 25) for s in (1, 2) for p in (0, 1, 2)], "store_id int, product_id int, stock int")
    out, ckpt, whole = str(tmp_path / "out"), str(tmp_path / "ckpt"), folds.reserve_stock(spark.createDataFrame(rows, schema), shelf, ["request_id"])
    expected = {(r.request_id, r.outcome, r.stock_after) for r in whole.collect()}
    # Two batches, then a restart that finds a third.
    stream = land(spark, tmp_path / "feed", [rows[:30], rows[30:60]], schema)
    feeds.drain_to_files(ledger.reservations(stream, shelf, ["request_id"]), out, ckpt)
    stream = land(spark, tmp_path / "feed", [rows[60:]], schema)
    settled = feeds.drain_to_files(ledger.reservations(stream, shelf, ["request_id"]), out, ckpt)
    assert {(r.request_id, r.outcome, r.stock_after) for r in settled.collect()} == expected
    # Run once more with nothing new: nothing is settled twice.
    assert feeds.drain_to_files(ledger.reservations(stream, shelf, ["request_id"]), out, ckpt).count() == len(rows)


def test_credit_feed_equals_batch(spark, tmp_path):
    rng = random.Random(9)
    rows = [(i, rng.choice([1, 1, 2, 5, None]), rng.choice([None, *range(1, 9)]), rng.choice([None, *map(Decimal, range(-9, 9))])) for i in range(90)]
    schema = "request_id int, customer_id int, expected_version int, amount decimal(10,2)"
    accounts = spark.createDataFrame([(1, Decimal(50), 1), (2, Decimal(60), 2)], "customer_id int, available_credit decimal(10,2), version int")
    stream = land(spark, tmp_path / "feed", [rows[:30], rows[30:60], rows[60:]], schema)
    settled = feeds.drain_to_files(ledger.credit_changes(stream, accounts, ["request_id"]), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    whole = folds.adjust_credit(spark.createDataFrame(rows, schema), accounts, ["request_id"])
    columns = ("request_id", "outcome", "credit_after", "version_after")
    assert {tuple(r[c] for c in columns) for r in settled.collect()} == {tuple(r[c] for c in columns) for r in whole.collect()}


def test_ledgers_keep_state_and_read_nothing_they_wrote(spark, tmp_path):
    """A later batch reads its own rows only; levels come from the state store, one per shelf."""
    rows = [(i, 1, i % 7, 1) for i in range(70)]
    schema = "request_id int, store_id int, product_id int, qty int"
    shelf = spark.createDataFrame([(1, p, 8) for p in range(7)], "store_id int, product_id int, stock int")
    stream = land(spark, tmp_path / "feed", [rows[:40], rows[40:60], rows[60:]], schema)
    query = (
        ledger.reservations(stream, shelf, ["request_id"])
        .writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ckpt"))
        .trigger(availableNow=True).start()
    )
    query.awaitTermination()
    progress = [p for p in query.recentProgress if p["numInputRows"]]
    assert [p["numInputRows"] for p in progress] == [40, 20, 10]
    state = progress[-1]["stateOperators"][0]
    assert state["numRowsTotal"] == 7 and "rocksdbCommitCheckpointLatency" in str(state["customMetrics"])


def test_a_key_is_read_by_one_call():
    class Level:
        calls = 0

        def get(self):
            self.calls += 1

        def exists(self):
            self.calls += 1
            return False

    processor = ledger._Account(["request_id"], ["request_id", "outcome", "credit_after", "version_after"])
    processor._level = Level()
    assert [r.outcome for r in processor.handleInputRows((1,), iter([Row(request_id=1)]), None)] == [folds.CONFLICT]
    assert processor._level.calls == 1
