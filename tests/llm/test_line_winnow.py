import random

import numpy as np
import pytest

from ledgerloom.llm import line_winnow
from tests.llm.helpers import awkward, documents


def brute(rows, least):
    """Lines to delete: those in any stretch of ``least`` words that was there before."""
    first, gone = {}, {}
    for doc, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        lines = [line.strip() for line in (text or "").split("\n") if line.strip()]
        lost = gone.setdefault(doc, set())
        for i in range(len(lines)):
            for j in range(i, len(lines)):
                if sum(len(x.split()) for x in lines[i : j + 1]) >= least:
                    at = first.setdefault(tuple(lines[i : j + 1]), (doc, i))
                    if at != (doc, i):
                        low = max(i, at[1] + j - i + 1) if at[0] == doc else i
                        lost.update(range(low, j + 1))
    return {doc: len(lines) for doc, lines in gone.items()}


@pytest.mark.parametrize("seed,least", [(0, 1), (1, 5), (2, 8), (3, 12)])
def test_equals_brute_force(spark, seed, least):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcde") for _ in range(rng.randint(1, 6))) for _ in range(9)]
    rows = [(i, "\n".join(rng.choice([*pool, "", "  "]) for _ in range(rng.randint(0, 14)))) for i in range(120)]
    got = line_winnow.delete_repeated(documents(spark, rows), min_words=least).collect()
    assert {r.doc_id: r.n_removed for r in got} == brute(rows, least)
    lines = {i: [x for x in t.split("\n") if x.strip()] for i, t in rows}
    assert all(r.n_lines == len(lines[r.doc_id]) and len([x for x in r.text.split("\n") if x.strip()]) == r.n_lines - r.n_removed for r in got)


@pytest.mark.parametrize("breaks", [(), (20, 34)])
def test_passages_inside_lines(spark, breaks):
    """51 words that begin and end inside a line go, 50 stay; the first occurrence stays whole."""
    passage = ["p%d" % i for i in range(51)]

    def around(name, words):
        shared = " ".join(w + ("\n" if i in breaks else "") for i, w in enumerate(words)).replace("\n ", "\n")
        return f"{name}1 {shared} {name}2\nlast {name}"

    rows = [(1, around("one", passage)), (2, around("two", passage)), (3, around("three", passage[:50])), (4, " ".join(passage * 2)), (5, None)]
    got = {r.doc_id: r for r in line_winnow.delete_repeated(documents(spark, rows)).collect()}
    assert [got[i].text for i in (1, 3, 5)] == [rows[0][1], rows[2][1], None]
    assert got[2].text.split() == "two1 two2 last two".split() and got[2].n_removed == len(breaks[1:])
    assert got[4].text == "" and got[4].n_removed == 1
    stage = line_winnow.apply_words(documents(spark, rows)).collect()
    assert {r.doc_id: r.text for r in stage} == {i: r.text for i, r in got.items() if i != 4}
    assert all(r.n_chars == len(r.text) for r in stage if r.text is not None)


def test_windows_by_hand():
    words = line_winnow.np.array([3, 1, 9, 2, 2, 2])
    assert line_winnow.windows(words, 5).tolist() == [[0, 2], [1, 2], [2, 2], [2, 3], [2, 4], [3, 5]]


def test_awkward_rows(spark):
    rows = awkward()
    got = line_winnow.delete_repeated(documents(spark, rows)).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert by_id[1].text is None and by_id[2].text == ""
    assert by_id[7].n_removed == 0 and by_id[8].n_removed == 1 and by_id[8].text == ""
    assert line_winnow.delete_repeated(documents(spark, [])).collect() == []


def test_apply_keeps_columns_and_lengths(spark):
    line = " ".join("w%d" % i for i in range(30))
    rows = [(1, line + "\nown text"), (2, "before\n" + line + "\nafter"), (3, line), (4, None)]
    docs = documents(spark, rows)
    got = {r.doc_id: r for r in line_winnow.apply_stretches(docs, line_winnow.repeated_stretches(docs)).collect()}
    assert set(got) == {1, 2, 4}
    assert got[2].text == "before\nafter" and got[2].n_chars == len("before\nafter") and got[2].digest == "x"
    assert got[1].text == line + "\nown text" and got[4].text is None


def brute_words(rows):
    """Words to delete, by row: those in any 51 words that were there before, in the order of id and text hash."""
    span, first, gone = line_winnow.PASSAGE_WORDS, {}, {}
    for doc, row_hash, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        words = (text or "").split()
        lost = gone.setdefault((doc, row_hash), set())
        for i in range(len(words) - span + 1):
            at = first.setdefault(tuple(words[i : i + span]), (doc, row_hash, i))
            if at != (doc, row_hash, i):
                low = max(i, at[2] + span) if at[:2] == (doc, row_hash) else i
                lost.update(range(low, i + span))
    return {key: lost for key, lost in gone.items() if lost}


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_the_word_pass_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    passages = [[rng.choice(words) for _ in range(rng.randint(45, 90))] for _ in range(8)]
    passages.append(["again"] * 120)
    texts = []
    for _ in range(90):
        parts = [[rng.choice(words) for _ in range(rng.randint(0, 40))]]
        for _ in range(rng.randrange(4)):
            whole = rng.choice(passages)
            parts.append(whole[rng.randrange(3) : len(whole) - rng.randrange(3)])
            parts.append([rng.choice(words) for _ in range(rng.randint(0, 20))])
        texts.append(rng.choice((" ", "\n")).join(w for part in parts for w in part))
    rows = [(rng.choice((None, *range(40))), i, t) for i, t in enumerate(texts)] + [(7, 1000, None), (8, 1001, ""), (9, 5, texts[5]), (9, 5, texts[5])]
    table = spark.createDataFrame(rows, "doc_id long, row_hash long, text string").repartition(5)
    got = {(r.doc_id, r.row_hash): {i for s in r.stretches for i in range(s["first"], s["last"] + 1)} for r in line_winnow.repeated_words(table).collect()}
    assert {k: v for k, v in got.items() if v} == brute_words(rows[:-1]) and len(got) > 20


def test_selected_runs_equal_the_plain_rule():
    """Hashes word by word, and the last least one of every stretch of runs."""
    rng = np.random.default_rng(5)
    for n in [*range(45, 60), 300]:
        words = rng.integers(0, 1 << 63, 6 if n % 2 else 1000, dtype=np.uint64)[rng.integers(0, 6, n)]
        size, span = line_winnow.RUN_WORDS, line_winnow.PASSAGE_WORDS - line_winnow.RUN_WORDS + 1
        runs = []
        for at in range(n - size + 1):
            h = 0
            for w in words[at : at + size].tolist():
                h = (h * 0x9E3779B97F4A7C15 + w) % (1 << 64)
            h = (h ^ h >> 32) * 0xD6E8FEB86659FD93 % (1 << 64)
            h ^= h >> 32
            runs.append(h - (1 << 64) if h >> 63 else h)
        expected = sorted({max(range(at, at + span), key=lambda i: (-runs[i], i)) for at in range(len(runs) - span + 1)})
        found, places = line_winnow.selected_runs(words)
        assert places.tolist() == expected and found.tolist() == [runs[i] for i in expected]


def test_tables_on_the_way_are_removed(spark):
    """Once texts are without repeated lines, and again without repeated passages, only what is read on lies in the shared folder."""
    rng = random.Random(31)
    passage = " ".join("p%d" % i for i in range(60))
    docs = documents(spark, [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(20)])
    folder = f"{line_winnow.cut_lineage.__globals__['shared_dir'](spark).rstrip('/')}/ledgerloom-{spark.sparkContext.applicationId}"
    names = line_winnow.cut_lineage.__globals__["child_names"]
    before = set(names(spark, folder))
    left = line_winnow.delete_repeated(docs)
    # The texts without lines, places of repeated runs, and the stretches.
    assert len(set(names(spark, folder)) - before) == 3
    assert sum(len(r.text.split()) == 2 for r in left.collect()) == 19
