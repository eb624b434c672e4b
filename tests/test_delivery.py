import uuid
from datetime import datetime

from pyspark.sql import functions as F

from ledgerloom.functions.identifiers import name_uuid
from ledgerloom.streaming import delivery, feeds

ORDERS = "order_id long, created_at timestamp_ntz"


def test_identifiers_are_those_of_the_standard(spark):
    names = ["", "a", "1:reserve_stock", "é日😀", "x" * 500, None]
    got = spark.createDataFrame([(n,) for n in names], "n string").select("n", name_uuid(uuid.NAMESPACE_DNS, F.col("n"))).collect()
    assert {r[0]: r[1] for r in got} == {n: None if n is None else str(uuid.uuid5(uuid.NAMESPACE_DNS, n)) for n in names}


def orders(*ids, day=1):
    return [(i, datetime(2024, 1, day, 10)) for i in ids]


def test_no_event_is_delivered_twice(spark, tmp_path):
    path, handle = str(tmp_path / "out"), delivery.deliver_once(str(tmp_path / "out"))
    events = lambda rows: delivery.saga_events(spark.createDataFrame(rows, ORDERS))
    schema = events(orders(1)).schema
    handle(events(orders(1, 2, 2)), 0)
    handle(events(orders(1, 2, 2)), 0)  # the batch is tried again
    handle(events(orders(2, 3) + orders(4, day=2)), 1)  # and one event comes again in a later one
    handle(events(orders(4, day=2) + orders(1)), 2)
    got = delivery.delivered(spark, path, schema).collect()
    assert len(got) == len({r.event_id for r in got}) == 8
    assert {(r.saga_id, r.batch_id) for r in got} == {(str(uuid.uuid5(delivery.SAGAS, str(i))), b) for i, b in ((1, 0), (2, 0), (3, 1), (4, 1))}


def test_a_retry_does_not_take_later_batches_away(spark, tmp_path):
    path, handle = str(tmp_path / "out"), delivery.deliver_once(str(tmp_path / "out"))
    events = lambda rows: delivery.saga_events(spark.createDataFrame(rows, ORDERS))
    handle(events(orders(1)), 0)
    handle(events(orders(2)), 1)
    handle(events(orders(2)), 1)
    assert delivery.delivered(spark, path, events(orders(1)).schema).count() == 4


def test_stream_replayed_from_files(spark, tmp_path):
    feed, out = str(tmp_path / "feed"), str(tmp_path / "out")
    rows = delivery.saga_events(spark.createDataFrame(orders(*range(20)), ORDERS))
    for _ in range(2):  # the same events land twice
        rows.coalesce(1).write.mode("append").parquet(feed)
    stream = feeds.follow_parquet(spark, feed, rows.schema, max_files=1)
    feeds.drain(stream, delivery.deliver_once(out), str(tmp_path / "ckpt"))
    assert delivery.delivered(spark, out, rows.schema).count() == 40
    # A lost checkpoint replays the feed from its start as new batches of the same numbers.
    feeds.drain(stream, delivery.deliver_once(out), str(tmp_path / "ckpt2"))
    assert delivery.delivered(spark, out, rows.schema).count() == 40


def test_only_the_days_of_a_batch_are_read(spark, tmp_path):
    out = str(tmp_path / "out")
    events = delivery.saga_events(spark.createDataFrame(orders(1) + orders(2, day=2), ORDERS))
    delivery.deliver_once(out)(events, 0)
    plan = delivery.delivered(spark, out, events.schema).filter(F.col("created_day").isin([datetime(2024, 1, 2).date()]))
    assert "PartitionFilters: [isnotnull(created_day" in plan._jdf.queryExecution().executedPlan().toString()


def test_a_batch_is_stored_aside_once(spark, tmp_path, monkeypatch):
    stored, cut = [], delivery.cut_lineage
    monkeypatch.setattr(delivery, "cut_lineage", lambda rows: stored.append(1) or cut(rows))
    events = delivery.saga_events(spark.createDataFrame(orders(1, 2, 2), ORDERS))
    delivery.deliver_once(str(tmp_path / "out"))(events, 0)
    assert len(stored) == 1 and delivery.delivered(spark, str(tmp_path / "out"), events.schema).count() == 4
