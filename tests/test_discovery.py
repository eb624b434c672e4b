import json

from pyspark.sql import functions as F

from ledgerloom.operators import json_discovery as m


def documents(spark, tmp_path, docs):
    spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "id int, body string").write.parquet(str(tmp_path / "docs"))
    return spark.read.parquet(str(tmp_path / "docs")).withColumn("doc", F.try_parse_json("body"))


def plain(docs):
    found = {}

    def walk(path, value):
        kind = {dict: "object", list: "array", str: "string", bool: "boolean", type(None): "null"}.get(type(value), "number")
        found[path, kind] = found.get((path, kind), 0) + 1
        if isinstance(value, dict):
            for key, inner in value.items():
                walk(f"{path}.{key}" if key.isidentifier() else f'{path}."{key}"', inner)
        if isinstance(value, list):
            for inner in value:
                walk(path + "[*]", inner)

    for doc in docs:
        walk("$", json.loads(doc))
    return found


DOCS = [
    '{"a": {"b": [1, "x", {"c": null, "deep": [[[{"end": true}]]]}]}, "odd key": 1.5}',
    '{"a": 5, "odd key": "s", "list": []}',
    '[{"a": 1}, {"a": 2}]',
    '"text"',
    "null",
    "{}",
]


def test_every_path_of_every_depth(spark, tmp_path):
    got = m.json_paths(documents(spark, tmp_path, [*DOCS, None, "not json"]), "doc").collect()
    assert {(r.path, r.json_type): r.occurrences for r in got} == plain(DOCS)
    schemas = {r.path: r.merged_schema for r in got}
    assert schemas["$.a"] == "VARIANT" and schemas['$."odd key"'] == "VARIANT" and schemas["$.list"].startswith("ARRAY")


def test_the_table_is_scanned_once(spark, tmp_path):
    levels = m.json_nodes(documents(spark, tmp_path, DOCS), "doc")
    assert len(levels) == 9
    assert not any("/docs/" in f for level in levels for f in level.inputFiles())


def test_samples_are_cut_and_least(spark, tmp_path):
    docs = ['{"k": "%s"}' % ("b" * 80), '{"k": "%s"}' % ("a" * 80)]
    got = {r.path: r.sample_value for r in m.json_paths(documents(spark, tmp_path, docs), "doc").collect()}
    assert got["$.k"] == "a" * 50


def test_no_documents(spark, tmp_path):
    assert m.json_paths(documents(spark, tmp_path, [None]), "doc").collect() == []
