import random

import numpy as np
import pytest

from ledgerloom.llm import decontaminate as D
from tests.llm.helpers import awkward, documents, prose

ITEMS = "item_id long, text string, class int"


def items(rng):
    return [(i, prose(rng, n, "abcdefghijklmnop"), 0) for i, n in enumerate([9, 14, 20, 33, 40, 70])]


def test_finds_verbatim_and_paraphrased_items(spark):
    rng = random.Random(3)
    bench = items(rng)
    filler = [(i, prose(rng, 300, "abcdefghijklmnop")) for i in range(60)]
    planted = [(100 + i, prose(rng, 150) + " " + text.upper() + ", " + prose(rng, 150)) for i, text, _ in bench]
    words = bench[4][1].split()
    paraphrase = [w if i % 3 else "zz" + str(i) for i, w in enumerate(words)]
    rarest = sorted(D._item(4, words, np.ones(D.TERMS)).answer)
    rest = [(200, prose(rng, 80) + " " + " ".join(paraphrase[:20] + rarest + paraphrase[20:]) + " " + prose(rng, 80))]
    got = D.find_leaks(documents(spark, filler + planted + rest), spark.createDataFrame(bench + [(9, None, 0), (None, "x y", 0), (10, "...", 0)], ITEMS))
    found = {(r.doc_id, r.item_id, r.kind) for r in got.collect()}
    assert {(100 + i, i, "verbatim") for i, _, _ in bench} <= found
    assert {f[:2] for f in found} <= {(100 + i, i) for i, _, _ in bench} | {(200, 4)}


def test_awkward_rows(spark):
    bench = spark.createDataFrame([(1, "same text here and a few more words to fill it", 0)], ITEMS)
    rows = awkward() + [(50, "same text here and a few more words to fill it"), (50, "same text here and a few more words to fill it")]
    assert sorted(r.doc_id for r in D.find_leaks(documents(spark, rows), bench).collect()) == [50, 50]
    assert D.find_leaks(documents(spark, []), bench).collect() == []
    assert D.find_leaks(documents(spark, rows), spark.createDataFrame([], ITEMS)).collect() == []


def test_many_items_go_in_blocks(spark, monkeypatch):
    rng = random.Random(4)
    bench = items(rng)
    docs = documents(spark, [(i, prose(rng, 40) + " " + t + " " + prose(rng, 40)) for i, t, _ in bench])
    whole = sorted((r.doc_id, r.item_id, r.share) for r in D.find_leaks(docs, spark.createDataFrame(bench, ITEMS)).collect())
    monkeypatch.setattr(D, "ITEMS_AT_ONCE", 4)
    parts = sorted((r.doc_id, r.item_id, r.share) for r in D.find_leaks(docs, spark.createDataFrame(bench, ITEMS)).collect())
    assert whole == parts and len(whole) == len(bench)


def test_common_subsequence_equals_table():
    rng = random.Random(5)
    for _ in range(50):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 90))] for _ in "ab")
        row = [0] * (len(b) + 1)
        for x in a:
            before, row = row, [0] * (len(b) + 1)
            for j, y in enumerate(b):
                row[j + 1] = before[j] + 1 if x == y else max(before[j + 1], row[j])
        assert D.common_subsequence(a, b) == row[-1]


@pytest.mark.parametrize("replaced,least", [(0.2, 0.97), (0.4, 0.94)])
def test_recall_on_a_full_block(spark, replaced, least):
    """Copies with scattered words replaced, the rarest kept, against the leak rule applied to each planted pair."""
    rng = random.Random(11)
    vocabulary = [prose(rng, 1, "abcdefghijklmnop") for _ in range(6000)]
    text = lambda n: [vocabulary[min(int(rng.paretovariate(0.6)), 6000) - 1] for _ in range(n)]
    bench = [text(rng.randint(12, 60)) for _ in range(D.ITEMS_AT_ONCE // 2)]
    filler = [(10_000 + i, " ".join(text(200))) for i in range(500)]
    counts, n = D.document_frequencies(documents(spark, filler).select("text"))
    idf = np.log((1 + n) / (1 + counts)) + 1e-3
    rows, expected = [], set()
    for i, words in enumerate(bench[:250]):
        item = D._item(i, words, idf)
        others = [at for at, w in enumerate(words) if w not in item.answer]
        gone = set(rng.sample(others, min(len(others), int(replaced * len(words)))))
        copy = text(70) + [rng.choice(vocabulary) if at in gone else w for at, w in enumerate(words)] + text(70)
        rows.append((i, " ".join(copy)))
        if D.common_subsequence(words, copy) >= D.PARAPHRASE * len(words) and item.answer <= set(copy):
            expected.add((i, i))
    items = [D._item(i, words, idf) for i, words in enumerate(bench)]
    space = D.latent_space(documents(spark, filler).select("text"), [D.terms_of(i.words) for i in items], idf)
    index = D.build_index(items, space, idf)
    found = {(doc, leak[0]) for doc, copy in rows for leak in D.leaks(copy, index)}
    assert len(expected) >= 200 and len(found & expected) >= least * len(expected)


def test_candidates_equal_plain_cosines():
    rng = np.random.default_rng(6)
    space = np.linalg.qr(rng.standard_normal((D.TERMS, 8)))[0]
    idf = rng.random(D.TERMS) + 0.1
    group = [D.Item(i, ["w%d" % j for j in range(i, i + n)], frozenset()) for i, n in enumerate([9, 17, 40])]
    index = D.build_index(group, space, idf)
    terms = rng.integers(0, D.TERMS, 101)
    vector = idf[:, None] * space
    expected = set()
    for item in group:
        length = D.window_length(len(item.words))
        target = vector[D.terms_of(item.words)].sum(axis=0)
        for at in range(0, len(terms), length // 2):
            window = vector[terms[at : at + length]].sum(axis=0)
            if at + length // 2 < len(terms) and window @ target / np.linalg.norm(window) / np.linalg.norm(target) >= 0.2:
                expected.add((item.item_id, at))
    found = {(i.item_id, at) for i, at, _ in D.candidates(terms, index, 0.2)}
    assert expected <= found


def test_gram_product_equals_dense():
    rng = np.random.default_rng(7)
    idf, block = rng.random(D.TERMS) + 0.1, rng.standard_normal((D.TERMS, 3))
    passages = [rng.integers(0, 40, n) for n in (5, 9, 0, 1)]
    dense = np.zeros((4, D.TERMS))
    for i, p in enumerate(passages):
        np.add.at(dense[i], p, 1)
    dense *= idf
    dense /= np.maximum(np.linalg.norm(dense, axis=1, keepdims=True), 1e-12)
    assert np.allclose(D.gram_times(passages, idf, block), dense.T @ (dense @ block))


def test_space_is_learned_from_every_document(spark):
    """One document among thousands, whatever its id, moves the space as the exact product says."""
    rng = random.Random(8)
    texts = [(i, prose(rng, 40, "abcdefgh")) for i in range(3000)]
    rare = [(5000, " ".join(f"zz{i}" for i in range(32)))]
    idf, block = np.ones(D.TERMS), np.linalg.qr(np.random.default_rng(9).standard_normal((D.TERMS, 5)))[0]
    passages = [p for _, text in texts + rare for p in D._passages(D.terms_of(D.words_of(text)), D.FIT_WORDS)]
    got, n = D._corpus_product(D.with_terms(documents(spark, texts + rare).select("text")).select("terms"), idf, block)
    assert n == 3001 and np.allclose(got, D.gram_times(passages, idf, block), atol=1e-4 * np.abs(got).max())
    seen = D.terms_of(D.words_of(rare[0][1]))
    without = D.gram_times(passages[:-1], idf, block)
    assert not np.allclose(got[seen], without[seen], atol=1e-3 * np.abs(got).max() / len(texts))


def test_items_set_aside_are_in_no_text():
    rng = random.Random(12)
    group = [D.Item(i, prose(rng, rng.randint(5, 40), "abc").split(), frozenset()) for i in range(60)]
    index = D.build_index(group, np.linalg.qr(np.random.default_rng(2).standard_normal((D.TERMS, 8)))[0], np.ones(D.TERMS))
    for _ in range(20):
        words = prose(rng, 30, "abc").split()
        some = D.possible(D.terms_of(words), index)
        kept = {index.items[length][0][i].item_id for length, at in some.items() for i in at.tolist()}
        assert {i.item_id for i in group if D.common_subsequence(i.words, words) >= D.PARAPHRASE * len(i.words)} <= kept
