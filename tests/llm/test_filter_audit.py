import random
import re
from collections import Counter
from itertools import permutations

from pyspark.sql import types as T

from ledgerloom.llm import filter_audit as m
from tests.llm.helpers import awkward, documents, prose

LABELS = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "quality", "toxic", "good")])


def failures(rows):
    """Letters each (id, text) row fails, by the contract."""
    smallest = {}
    for doc, text in rows:
        if doc is not None:
            smallest[text or ""] = min(doc, smallest.get(text or "", doc))
    found = []
    for doc, text in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc is not None and doc > smallest[text],
        }
        found.append({x for x, bad in failed.items() if bad})
    return found


def plain_audit(rows, parts, labels):
    failed, out = failures(rows), {}
    good = {d for d, quality, _ in labels if quality == 1 and d is not None}
    toxic = {d for d, _, bad in labels if bad == 1 and d is not None}
    for part in set(parts):
        shapley = Counter()
        for order in permutations("ABCDE"):
            alive = [i for i in range(len(rows)) if parts[i] == part]
            everyone = list(alive)
            for step, letter in enumerate(order, 1):
                gone = [i for i in alive if letter in failed[i]]
                shapley[letter] += len(gone)
                out[part, "".join(order), step] = [
                    len(alive) - len(gone),
                    len(gone),
                    sum(letter in failed[i] for i in everyone) - len(gone),
                    sum(failed[i] == {letter} for i in everyone),
                    sum(rows[i][0] in good for i in gone),
                    sum(rows[i][0] in toxic for i in gone),
                ]
                alive = [i for i in alive if i not in set(gone)]
        for (where, order, step), counts in out.items():
            if where == part:
                counts.append(shapley[order[step - 1]])
    return out


def audited(spark, rows, parts, labels):
    from pyspark.sql import functions as F

    docs = documents(spark, rows).drop("source")
    sources = F.element_at(F.create_map(*[x for i, p in enumerate(parts) for x in (F.lit(i), F.lit(p))]), F.col("n"))
    docs = docs.coalesce(1).withColumn("n", F.monotonically_increasing_id().cast("int")).withColumn("source", sources)
    said = spark.createDataFrame([(*x, 7) for x in labels], LABELS)
    # Names used inside, and one more column with a name of the other table.
    docs = docs.withColumns({"row": F.lit(1), "part": F.lit("?"), "quality": F.lit(1), "sets": F.lit("x")})
    return {tuple(r[:3]): list(r[3:]) for r in m.audit(docs, said).collect()}


def test_against_brute_force(spark):
    rng = random.Random(8)
    rows = [r for r in awkward() if len(r[1] or "") < 1000]
    for i in range(120):
        text = prose(rng, rng.choice((10, 49, 50, 80)), rng.choice(("ab", "abcdefghijklmno")))
        text = text.upper() if rng.random() < 0.3 else text
        text += rng.choice(("", "", " $", "|#"))
        rows += [(1000 + i, text)] * (1 if i % 9 else 2)
        if i % 4 == 0:
            rows.append((500 + i, text))
    parts = [rng.choice(("web", "books", None)) for _ in rows]
    labels = [(d, rng.choice((0, 1, None)), rng.choice((0, 1))) for d, _ in rows if rng.random() < 0.6] + [(None, 1, 1), (99999, 1, 1)]
    got = audited(spark, rows, parts, labels)
    assert got == plain_audit(rows, [p or "" for p in parts], labels)


def test_long_texts_and_zero_rows(spark):
    rows = awkward()
    got = audited(spark, rows, ["only"] * len(rows), [])
    assert len(got) == 600 and got == plain_audit(rows, ["only"] * len(rows), [])


def test_empty_table(spark):
    docs, labels = documents(spark, []), spark.createDataFrame([], LABELS)
    assert m.audit(docs, labels).collect() == []


def test_id_tables(spark):
    rows = [(1, "a"), (2, "a"), (2, "a"), (None, "a"), (3, "word " * 60), (4, "ABC #")]
    _, tables = m.failing_ids(documents(spark, rows), spark.createDataFrame([], LABELS))
    ids = {x: sorted((r.doc_id for r in t.collect()), key=repr) for x, t in tables.items()}
    assert ids == {"A": [1, 2, 2, 4, None], "B": [3], "C": [4], "D": [4], "E": [2, 2]}
