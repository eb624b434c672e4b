import random
from datetime import datetime, timedelta
from decimal import Decimal

from ledgerloom.operators import visits
from ledgerloom.streaming import feeds
from ledgerloom.streaming import visits as live

SCHEMA = "order_id long, customer_id long, store_id int, order_date timestamp_ntz, total_amount decimal(18,2), channel string"
START = datetime(2024, 1, 1, 10, 0, 0)


def frame(spark, moments, customer=1, store=1):
    rows = [(i, customer, store, m, Decimal(i + 1), "retail") for i, m in enumerate(moments)]
    return spark.createDataFrame(rows, SCHEMA)


def brute_visits(rows):
    """Pairs of consecutive transactions, one by one."""
    out, last, current = [], {}, {}
    for _, customer, store, moment, amount, channel in sorted(rows, key=lambda r: (r[3], r[0])):
        if channel != "retail":
            continue
        key = (customer, store)
        minute = moment.replace(second=0, microsecond=0)
        if key not in last or (minute - last[key]) > timedelta(minutes=15):
            current[key] = [moment, moment, 0, Decimal(0)]
            out.append((key, current[key]))
        visit = current[key]
        visit[1], visit[2], visit[3] = moment, visit[2] + 1, visit[3] + amount
        last[key] = minute
    return sorted((k[0], k[1], *v) for k, v in out)


def test_gap_counts_minute_boundaries(spark):
    # 15 minutes and one second apart, but 16 boundaries.
    apart = visits.retail_visits(frame(spark, [datetime(2024, 1, 1, 10, 0, 59), datetime(2024, 1, 1, 10, 16, 0)]))
    assert apart.count() == 2
    # Nearly 16 minutes apart, but 15 boundaries.
    together = visits.retail_visits(frame(spark, [datetime(2024, 1, 1, 10, 0, 0), datetime(2024, 1, 1, 10, 15, 59)]))
    assert together.count() == 1


def random_rows():
    rng = random.Random(5)
    rows = []
    for i in range(400):
        customer = rng.choice([1, 1, 1, 2, 3])
        moment = START + timedelta(seconds=rng.randrange(0, 40_000))
        rows.append((i, customer, rng.choice([1, 2]), moment, Decimal(rng.randrange(100)), rng.choice(["retail", "retail", "online"])))
    return rows


def test_matches_pairwise_rule(spark):
    rows = random_rows()
    got = visits.retail_visits(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.customer_id, r.store_id, r.visit_start, r.visit_end, r.transaction_count, r.visit_total) for r in got) == brute_visits(rows)
    assert sum(r.transaction_count for r in got) == sum(1 for r in rows if r[5] == "retail")
    for key in {(r.customer_id, r.store_id) for r in got}:
        numbers = sorted(r.visit_group for r in got if (r.customer_id, r.store_id) == key)
        assert numbers == list(range(1, len(numbers) + 1))


def test_stream_gives_the_batch_visits(spark, tmp_path):
    rows = random_rows()
    # A much later transaction moves the watermark past every visit; its own stays open.
    rows.append((1000, 99, 1, START + timedelta(days=2), Decimal(1), "retail"))
    frame = spark.createDataFrame(rows, SCHEMA)
    frame.repartition(4).write.parquet(str(tmp_path / "feed"))
    stream = feeds.follow_parquet(spark, str(tmp_path / "feed"), frame.schema)
    closed = feeds.drain_to_files(live.visit_stream(stream, "5 minutes"), str(tmp_path / "out"), str(tmp_path / "ckpt"))
    got = sorted((r.customer_id, r.store_id, r.visit_start, r.visit_end, r.transaction_count, r.visit_total) for r in closed.collect())
    assert got == [v for v in brute_visits(rows) if v[0] != 99]


def test_empty_input(spark):
    assert visits.retail_visits(spark.createDataFrame([], SCHEMA)).count() == 0
