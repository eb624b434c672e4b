import random

from ledgerloom.operators import reconcile as m

SHAPE = m.TreeShape(4, 2)
ROW = "product_id long, name string, price int"


def stored(spark, path, rows):
    table = spark.createDataFrame(rows, ROW)
    m.store(table, "product_id", str(path), SHAPE)
    return table.schema


def verdicts(spark, one, other, schema):
    return {tuple(r) for r in m.reconcile(spark, str(one), str(other), schema, "product_id", SHAPE).collect()}


def test_differences_are_named(spark, tmp_path):
    rng = random.Random(2)
    rows = {i: (i, rng.choice("abc"), rng.choice([None, 1, 2])) for i in range(300)}
    copy = dict(rows)
    for i in (3, 77):
        del copy[i]
    copy[5] = (5, "changed", 1)
    copy[6] = (6, rows[6][1], None if rows[6][2] else 9)
    copy[1000] = (1000, "x", 1)
    schema = stored(spark, tmp_path / "a", rows.values())
    stored(spark, tmp_path / "b", list(copy.values())[::-1])
    found = verdicts(spark, tmp_path / "a", tmp_path / "b", schema)
    assert found == {(3, "MISSING"), (77, "MISSING"), (5, "STALE"), (6, "STALE"), (1000, "SURPLUS")}


def test_only_unequal_leaves_are_read(spark, tmp_path):
    rows = [(i, "n", 1) for i in range(400)]
    schema = stored(spark, tmp_path / "a", rows)
    stored(spark, tmp_path / "b", [(i, "n", 2 if i == 42 else 1) for i in range(400)])
    leaves = m.differing_leaves(spark, str(tmp_path / "a"), str(tmp_path / "b"), SHAPE)
    assert len(leaves) == 1
    read = m.read_leaves(spark, str(tmp_path / "a"), schema, leaves)
    assert "PartitionFilters: [isnotnull(leaf" in read._jdf.queryExecution().executedPlan().toString()
    # The folders of all other leaves may be gone: nothing of them is read.
    whole = m.reconcile(spark, str(tmp_path / "a"), str(tmp_path / "b"), schema, "product_id", SHAPE)
    assert {f.split("leaf=")[1].split("/")[0] for f in read.filter(f"leaf = {leaves[0]}").select("leaf").inputFiles()} >= {str(leaves[0])}
    assert whole.collect() == [(42, "STALE")]
    assert 0 < read.count() < 60


def test_equal_copies_stop_at_the_root(spark, tmp_path):
    rows = [(i, None if i % 3 else "n", i) for i in range(50)]
    schema = stored(spark, tmp_path / "a", rows)
    stored(spark, tmp_path / "b", rows[::-1])
    assert m.differing_leaves(spark, str(tmp_path / "a"), str(tmp_path / "b"), SHAPE) == []
    assert verdicts(spark, tmp_path / "a", tmp_path / "b", schema) == set()


def test_nulls_that_change_places_and_repeated_rows_show(spark, tmp_path):
    two = "product_id long, a string, b string"
    for name, rows in {"a": [(1, None, "x"), (2, "y", "y")], "b": [(1, "x", None), (2, "y", "y")], "c": [(1, None, "x"), (2, "y", "y"), (2, "y", "y"), (2, "y", "y")]}.items():
        m.store(spark.createDataFrame(rows, two), "product_id", str(tmp_path / name), SHAPE)
    differ = lambda a, b: m.differing_leaves(spark, str(tmp_path / a), str(tmp_path / b), SHAPE)
    assert differ("a", "b") and differ("a", "c") and not differ("a", "a")


def test_an_empty_copy(spark, tmp_path):
    schema = stored(spark, tmp_path / "a", [(1, "n", 1), (2, "n", 2)])
    m.store(spark.createDataFrame([], ROW), "product_id", str(tmp_path / "b"), SHAPE)
    assert verdicts(spark, tmp_path / "a", tmp_path / "b", schema) == {(1, "MISSING"), (2, "MISSING")}
