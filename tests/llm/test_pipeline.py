import random

import __spark_entry__ as contract
import corpus_pipeline
from ledgerloom.llm import registry
from ledgerloom.session import cut_lineage
from tests.llm.helpers import DOCS, documents, prose


def test_registered():
    names = contract.queries()
    assert "pipeline" in names and set(registry.QUERIES) <= set(names)
    assert sorted(int(n[2:].split("_")[0]) for n in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLE_SQL) <= set(contract.oracle_sql())


def test_stages(spark, tmp_path):
    rng = random.Random(6)
    line = prose(rng, 40)
    item = prose(rng, 30)
    near = prose(rng, 100).split()
    clean = [(i, prose(rng, 60), "en") for i in range(20)]
    rows = clean + [
        (30, None, "en"), (31, "123 ... 456", "en"), (32, "", "en"),
        (40, line + "\n" + clean[0][1] + " a", "en"), (41, prose(rng, 30) + "\n" + line + "\n" + prose(rng, 30), None), (42, line, "en"),
        (50, " ".join(near), "en"), (51, " ".join([*near[:60], "changed", *near[61:]]), "en"),
        (60, prose(rng, 50) + " " + item + " " + prose(rng, 50), "en"),
        (None, prose(rng, 30), "en"), (70, prose(rng, 25), "en"), (70, prose(rng, 25), "en"),
    ]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, kept = documents(spark, rows), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES, 1):
        docs = cut_lineage(stage(spark, docs, str(tmp_path)))
        kept.append([r.doc_id for r in docs.collect()])
        if number < len(corpus_pipeline.STAGES):
            assert docs.columns == DOCS.names
        if number == 2:
            texts = {r.doc_id: r for r in docs.collect()}
    ids = [r[0] for r in rows]
    assert set(ids) - set(kept[0]) == {30, 31, 32} and kept[0].count(70) == 2
    assert set(kept[0]) - set(kept[1]) == {42}
    assert texts[41].text.count("\n") == 1 and texts[41].n_chars == len(texts[41].text) and texts[41].lang == "en"
    assert set(kept[1]) - set(kept[2]) == {40, 51} - ({40} & set(kept[2])) and kept[2].count(70) == 2 and None in kept[2]
    assert set(kept[2]) - set(kept[3]) == {60}
    assert sorted(map(repr, kept[3])) == sorted(map(repr, kept[4]))


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def awkward_table(spark, rng):
    """Null and repeated ids, copies, names that stages use themselves, empty and very long texts."""
    near = prose(rng, 120).split()
    long = prose(rng, 20_000)
    rows = [
        (None, prose(rng, 40), "en"), (None, prose(rng, 40), None), (None, near and " ".join(near), "en"),
        (900, prose(rng, 40), "en"), (900, prose(rng, 40), "de"), (900, None, "en"), (901, "", None), (902, " \t\n", "en"),
        (5, " ".join([*near[:70], "changed", *near[71:]]), "en"), (7, " ".join(near), "en"), (7, " ".join(near), "en"),
        (10, long, "en"), (11, long, "en"), (12, "x" * 60_000, "en"), *[(20 + i, prose(rng, 30), "en") for i in range(10)],
    ]
    from pyspark.sql import functions as F

    docs = documents(spark, rows)
    for name in ("_id", "_again", "_of", "_of_hash", "_left", "_stretches", "_lang", "found", "text_key", "kept_row", "of", "left", "stretches", "leaking"):
        docs = docs.withColumn(name, F.lit(f"value of {name}"))
    return docs, rows


def test_rows_are_kept_apart_in_every_stage(spark, tmp_path):
    rng = random.Random(13)
    docs, rows = awkward_table(spark, rng)
    leaked = rows[4][1]
    spark.createDataFrame([(1, leaked)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    whole = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id is not None and r.text is not None)

    got = stages["language ID"](spark, docs, str(tmp_path)).collect()
    assert len(got) == len([r for r in rows if r[1] and r[1].strip()])
    assert sorted(r.lang for r in got if r.doc_id == 900) == ["de", "en"]
    assert all(r["_id"] == "value of _id" and r.found == "value of found" for r in got)

    got = stages["line dedup"](spark, docs, str(tmp_path)).collect()
    assert len(got) <= len(rows) and [r.text for r in got if r.doc_id == 900 and r.text is None] == [None]
    assert {(r.doc_id, r.text) for r in got} <= {(r[0], r[1]) for r in rows}

    got = stages["MinHash near-dedup"](spark, docs, str(tmp_path)).collect()
    texts = {(r.doc_id, r.text) for r in got}
    # Of the near copies (null, 5, 7, 7) the smallest id stays; unlike documents of one id all stay.
    assert sum(r.doc_id in (5, 7) for r in got) == 1 and (5, rows[8][1]) in texts
    assert {t for d, t in texts if d == 900} == {rows[3][1], rows[4][1], None}
    assert sum(r.doc_id is None for r in got) == 2 and sum(r.doc_id in (10, 11) for r in got) == 1
    assert (901, "") in texts and (902, " \t\n") in texts
    assert all(r.text_key == "value of text_key" for r in got)

    got = stages["benchmark decontamination"](spark, docs, str(tmp_path)).collect()
    # Only the row that leaks goes, not the others of its id.
    assert sorted((r.doc_id, r.text) for r in got if r.doc_id is not None and r.text is not None) == [w for w in whole if w[1] != leaked]
    assert len(got) == len(rows) - 1

    got = stages["BPE encoding and decoding"](spark, docs, str(tmp_path)).collect()
    assert len(got) == len(rows)


def test_every_row_leaves_at_most_once(spark, tmp_path):
    docs, rows = awkward_table(spark, random.Random(14))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()]
    given = [r[0] for r in rows]
    assert all(got.count(d) <= given.count(d) for d in set(got)) and got.count(900) == 2 and got.count(None) == 2
