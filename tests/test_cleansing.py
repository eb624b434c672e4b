import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import json_values as J
from ledgerloom.operators import json_clean, quality, serving

GOOD = ['{"a":1}', "[1,2]", "5", '"x"', "null", "true", ' {"b":[{}]} ', '{"v":1}', '{"a":1,"a":2}']
BAD = {
    '{"a":1} x': "trailing_text",
    '{"a":1}}': "trailing_text",
    "[1],[2]": "trailing_text",
    '{"a":1},{"b":2}': "trailing_text",
    "[1,2": "not_json",
    "abc": "not_json",
    "1,2": "not_json",
    '1,"w":2': "not_json",
    "1]": "not_json",
    "": "empty",
    " \t": "empty",
}


def test_strict_parse(spark):
    rows = spark.createDataFrame([(t,) for t in [*GOOD, *BAD, None]], "t string")
    got = {r.t: (r.p, r.r) for r in rows.select("t", F.to_json(J.parse_strict(F.col("t"))).alias("p"), J.reject_reason(F.col("t"), J.parse_strict(F.col("t"))).alias("r")).collect()}
    for text in GOOD:
        assert json.loads(got[text][0]) == json.loads(text) and got[text][1] is None
    for text, reason in BAD.items():
        assert got[text] == (None, reason)
    assert got[None][0] is None


def test_text_to_json_keeps_filled_targets(spark):
    rows = spark.createDataFrame([("{bad", None), ("plain", None), ('{"k":1}', '"kept"'), (None, None)], "d string, j string")
    got = [r.j for r in json_clean.text_to_json(rows, "d", "j").collect()]
    assert got == ['{"parse_error":"not_json","raw_text":"{bad"}', '{"raw_text":"plain"}', '"kept"', None]


def documents(spark, texts):
    return json_clean.with_document(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), F.col("t"))


@pytest.mark.parametrize(
    "before,after",
    [
        ('{"category":"television","screen_size":"55.50 inches"}', 55.5),
        ('{"category":"television","screen_size":{"size":55}}', 55),
        ('{"category":"television","screen_size":[55,60]}', 55),
        ('{"category":"television","screen_size":"1.2.3"}', None),
        ('{"category":"television","screen_size":""}', None),
        ('{"category":"television","screen_size":true}', None),
        ('{"category":"television","screen_size":null}', None),
        ('{"category":"television","screen_size":{"size":"x"}}', None),
    ],
)
def test_normalize_numeric(spark, before, after):
    doc = json_clean.normalize_numeric(documents(spark, [before]), "doc", "screen_size").select(F.to_json("doc").alias("j")).first().j
    assert json.loads(doc) == {"category": "television", "screen_size": after}


@pytest.mark.parametrize(
    "text",
    ['{"category":"radio","screen_size":"5"}', '{"category":"television"}', '{"screen_size":"5"}', '{"category":"television","screen_size":5}'],
)
def test_normalize_leaves_others_alone(spark, text):
    doc = json_clean.normalize_numeric(documents(spark, [text]), "doc", "screen_size").select(F.to_json("doc").alias("j")).first().j
    assert json.loads(doc) == json.loads(text)


def test_alias_value_survives(spark):
    rows = documents(spark, ['{"category":"television","display_size":"42 in"}', '{"category":"television","display_size":1,"screen_size":2}'])
    merged = json_clean.merge_alias(rows, "doc", "display_size", "screen_size").orderBy("id").select(F.to_json("doc").alias("j")).collect()
    assert json.loads(merged[0].j) == {"category": "television", "screen_size": "42 in"}
    assert json.loads(merged[1].j) == {"category": "television", "display_size": 1, "screen_size": 2}


def test_contract_is_true_for_unknowns(spark):
    texts = [None, "[]", "{}", '{"category":"television"}', '{"category":"television","screen_size":"x"}', '{"category":"refrigerator","capacity_liters":null}']
    rows = json_clean.contract_check(documents(spark, texts), "id", "doc").orderBy("id").collect()
    assert [r.is_valid for r in rows] == [True, True, True, True, False, False]


def test_containment(spark):
    doc = '{"raw_text":"laptop","tags":["a",1,{"x":2}],"deep":{"n":1.0,"z":null,"ok":true}}'
    row = documents(spark, [doc])

    def holds(wanted):
        return row.select(serving.contains(F.col("doc"), wanted).alias("c")).first().c

    assert holds({"raw_text": "laptop"}) and holds({"deep": {"n": 1}}) and holds({"tags": ["a", {"x": 2}]})
    assert holds({"deep": {"z": None, "ok": True}}) and holds({})
    assert not holds({"raw_text": "lap"}) and not holds({"deep": {"n": "1"}}) and not holds({"tags": ["b"]})
    assert not holds({"missing": None}) and not holds({"deep": {"ok": 1}})


def test_holding_row_is_added_once(spark):
    parents = spark.createDataFrame(
        [(1, "a", "a@x", 5, True, datetime(2024, 1, 1))],
        "customer_id long, name string, contact_email string, score int, active boolean, since timestamp_ntz",
    )
    options = {"name": "Holding", "email": "legal@x", "as_of": datetime(2024, 5, 1)}
    once = quality.ensure_default_parent(parents, "customer_id", **options)
    row = once.filter("customer_id = -1").first()
    assert (row.name, row.contact_email, row.score, row.active, row.since) == ("Holding", "legal@x", 0, False, datetime(2024, 5, 1))
    assert quality.ensure_default_parent(once, "customer_id", **options).count() == 2


def test_reparent_keeps_null_keys_and_then_no_violation_is_left(spark):
    parents = spark.createDataFrame([(1,), (-1,)], "customer_id long")
    children = spark.createDataFrame([(10, 1), (11, 99), (12, None)], "plan_id int, customer_id long")
    fixed = quality.reparent_orphans(children, parents, "customer_id", "customer_id")
    assert {r.plan_id: r.customer_id for r in fixed.collect()} == {10: 1, 11: -1, 12: None}
    assert quality.fk_violations(fixed, parents, "customer_id", "customer_id").isEmpty()


def test_rules_with_null_pass(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "b"), (-1, None)], "n int, s string")
    report = quality.constraint_report(rows, {"positive": F.col("n") > 0, "named": F.col("s").isNotNull()})
    assert {r.rule: r.violations for r in report.collect()} == {"positive": 1, "named": 1}


def test_numbers_keep_all_their_digits(spark):
    texts = ["55", "055", "5.", ".5", "-0.50", "+7", "1e3", "0.12345678901234567890123", "123456789012345678901234567890", "1.2.3", "", "abc", None, " 8 ", "-.25"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r[0]: r[1] for r in rows.select("t", F.to_json(J.number_of(F.col("t")))).collect()}
    assert {t: got[t] for t in texts} == {
        "55": "55", "055": "55", "5.": "5", ".5": "0.5", "-0.50": "-0.5", "+7": "7", "1e3": "1000.0", "0.12345678901234567890123": "0.12345678901234567890123",
        "123456789012345678901234567890": "123456789012345678901234567890", "1.2.3": None, "": None, "abc": None, None: None, " 8 ": "8", "-.25": "-0.25",
    }
