import random

from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ledgerloom.operators import serving
from ledgerloom.sources import tables
from ledgerloom.streaming import ratings

REVIEWS = "product_id long, rating int"
CHANGES = "old_product_id long, old_rating int, new_product_id long, new_rating int"
LONG = LongType()


def random_history(rng, reviews, batches, size):
    """Batches of changes, and the reviews after all of them."""
    left, out = list(reviews), []
    for _ in range(batches):
        changes = []
        for _ in range(size):
            kind = rng.choice("iudm")
            new = (rng.choice([None, *range(30)]), rng.choice([None, 1, 2, 3, 4, 5]))
            if kind == "i" or not left:
                changes.append((None, None, *new))
                left.append(new)
                continue
            old = left.pop(rng.randrange(len(left)))
            if kind == "d":
                changes.append((*old, None, None))
                continue
            new = (old[0], new[1]) if kind == "u" else new
            changes.append((*old, *new))
            left.append(new)
        out.append(changes)
    return out, left


def seen(df):
    return sorted((r.product_id, r.avg_rating, r.review_count) for r in df.collect())


def recomputed(spark, reviews):
    return seen(serving.product_ratings(spark.createDataFrame([r for r in reviews if r[0] is not None], REVIEWS)))


def test_deltas_equal_a_recompute(spark, tmp_path):
    rng, path = random.Random(3), str(tmp_path / "view")
    reviews = [(rng.randrange(20), rng.choice([None, 1, 2, 3, 4, 5])) for _ in range(60)]
    ratings.build(spark.createDataFrame(reviews, REVIEWS), path, 8)
    handle = ratings.maintain(path, LONG, 8)
    batches, left = random_history(rng, reviews, 4, 25)
    for number, changes in enumerate(batches):
        handle(spark.createDataFrame(changes, CHANGES), number)
        handle(spark.createDataFrame(changes, CHANGES), number)  # tried again: nothing is added twice
    assert seen(ratings.ratings(spark, path, LONG)) == recomputed(spark, left)


def test_a_batch_that_failed_half_way_is_completed(spark, tmp_path):
    path = str(tmp_path / "view")
    reviews = [(p, 4) for p in range(40)]
    ratings.build(spark.createDataFrame(reviews, REVIEWS), path, 8)
    changes = spark.createDataFrame([(p, 4, None, None) for p in range(20)] + [(None, None, 100 + p, 2) for p in range(20)], CHANGES)
    # Half of the buckets are replaced, then the task set is lost.
    change = ratings.deltas(changes)
    after = ratings.merged(ratings.stored_rows(spark, path, LONG), change, 0).select("product_id", *ratings.SUMS, "applied", ratings._bucket(8))
    half = spark.createDataFrame(after.filter("bucket < 4").collect(), after.schema)
    tables.replace_partitions(half, path, ["bucket"])
    ratings.maintain(path, LONG, 8)(changes, 0)
    assert seen(ratings.ratings(spark, path, LONG)) == [(p, 4.0, 1) for p in range(20, 40)] + [(100 + p, 2.0, 1) for p in range(20)]
    # The empty rows go when a later batch comes by.
    ratings.maintain(path, LONG, 8)(spark.createDataFrame([(None, None, p, 1) for p in range(200, 240)], CHANGES), 1)
    assert ratings.stored_rows(spark, path, LONG).filter("reviews = 0").isEmpty()


def test_only_touched_buckets_are_read_and_replaced(spark, tmp_path):
    path = tmp_path / "view"
    ratings.build(spark.createDataFrame([(p, 3) for p in range(200)], REVIEWS), str(path), 16)
    files = lambda: {f: f.stat().st_mtime_ns for f in path.rglob("*.parquet")}
    before = files()
    ratings.maintain(str(path), LONG, 16)(spark.createDataFrame([(5, 3, 5, 1)], CHANGES), 0)
    bucket = spark.range(1).select(F.pmod(F.xxhash64(F.lit(5).cast("long")), F.lit(16))).first()[0]
    changed = set(before) ^ set(files())
    assert changed and {f.parent.name for f in changed} == {f"bucket={bucket}"}
    plan = ratings.stored_rows(spark, str(path), LONG, [3])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(bucket" in plan and "(bucket" in plan


def test_a_hot_product_is_summed_before_it_moves(spark):
    changes = spark.createDataFrame([(7, 1, 7, 5)] * 50 + [(8, 2, None, None)], CHANGES)
    plan = ratings.deltas(changes)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") >= 2
    assert {tuple(r) for r in ratings.deltas(changes).collect()} == {(7, 200, 0, 0), (8, -2, -1, -1)}
