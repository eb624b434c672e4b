import hashlib
import re

from ledgerloom.llm import content_sort
from tests.llm.helpers import awkward, documents, prose


def brute(rows):
    groups = {}
    for doc, text in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", text or ""), []).append((doc, text or ""))
    out = []
    for content, members in groups.items():
        best = min(members, key=lambda m: (-len(m[1]), m[0] is None, m[0] or 0))
        seen = False
        for doc, text in members:
            kept = (doc, text) == best and not seen
            seen |= kept
            out.append((doc, best[0], len(members), kept, hashlib.sha256(content.encode()).hexdigest()))
    return sorted(out, key=repr)


def result(df):
    return sorted([(r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in df.collect()], key=repr)


def test_awkward_rows(spark):
    rows = awkward()
    assert result(content_sort.exact_groups(documents(spark, rows))) == brute(rows)


def test_large_groups_are_split_and_joined_again(spark):
    import random

    rng = random.Random(1)
    rows = [(i, rng.choice(["hot", "h ot", "ho t "]) if i % 3 == 0 else prose(rng, 3, "ab")) for i in range(600)]
    split = content_sort.exact_groups(documents(spark, rows), max_hot=50, least_part=5)
    assert result(split) == brute(rows)
    assert sum(r[3] for r in result(split)) == len({r[4] for r in brute(rows)})


def test_empty_table(spark):
    assert content_sort.exact_groups(documents(spark, [])).collect() == []


def test_no_python_in_the_plan(spark):
    plan = content_sort.exact_groups(documents(spark, awkward()))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
