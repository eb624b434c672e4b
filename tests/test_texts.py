import random

from ledgerloom.operators import texts


def test_items_in_order(spark):
    rng = random.Random(5)
    rows = [(rng.choice("abc"), rng.choice([None, "", "é", "a b", *["".join(rng.choice("abz") for _ in range(rng.randint(1, 5))) for _ in range(40)]])) for _ in range(300)]
    got = texts.ordered_list(spark.createDataFrame(rows, "g string, item string"), ["g"], "item", ", ")
    expected = {g: ", ".join(sorted({i for h, i in rows if h == g and i is not None}, key=str.encode)) for g in "abc"}
    assert {r.g: r["item"] for r in got.collect()} == expected


def test_a_hot_group_is_gathered_in_parts(spark):
    rows = spark.range(20_000).selectExpr("'hot' AS g", "lpad(id, 6, '0') AS item")
    got = texts.ordered_list(rows, ["g"], "item", ",", prefix=4)
    assert got.first()["item"] == ",".join(f"{i:06d}" for i in range(20_000))
    # The group meets in one place only as 200 finished parts, not as its rows.
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("listagg") >= 4 and "_letters" in plan
