import itertools
import math
import random
import zlib

import numpy as np
import public_tokenizers

from ledgerloom.llm import language, lattice
from tests.llm.helpers import awkward, documents

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = {"aa": ["the", "and", "then", "thing", "other"], "bb": ["der", "und", "schon", "nicht", "ein"]}


def corpus(n=160):
    rng = random.Random(4)
    return [(i, " ".join(rng.choice(WORDS[lang]) for _ in range(12)), lang) for i in range(n) for lang in [rng.choice(["aa", "aa", "bb"])]]


def segmentations(word):
    for cuts in itertools.product([0, 1], repeat=len(word) - 1):
        parts, start = [], 0
        for i, cut in enumerate(cuts, 1):
            if cut:
                parts.append(word[start:i])
                start = i
        yield [*parts, word[start:]]


def test_forward_sums_all_segmentations():
    pieces = ["a", "b", "ab", "ba", "aba", "▁", "▁a"]
    rng = np.random.default_rng(1)
    probability = rng.random((len(pieces) + 1, 3))
    place = {p: i for i, p in enumerate(pieces)}
    scorer = language.Scorer(pieces, probability)
    words = ["▁abab", "▁", "▁axb", "b", "ababa"]
    got = scorer.log_probability(words)
    for word, row in zip(words, got):
        total = sum(np.prod([probability[place.get(p, -1)] for p in parts], axis=0) for parts in segmentations(word) if all(p in place or (len(p) == 1 and p not in place) for p in parts))
        assert np.allclose(np.exp(row), total)


def test_long_words_do_not_underflow():
    pieces = ["a", "b", "ab"]
    probability = np.full((4, 2), 1e-5)
    scorer = language.Scorer(pieces, probability)
    short, long = scorer.log_probability(["a" * 20, "a" * 5000])
    assert np.allclose(short, 20 * math.log(1e-5)) and np.allclose(long, 5000 * math.log(1e-5))


def test_expected_counts_by_hand():
    scorer = language.Scorer(["a", "b", "ab"], np.array([[0.5], [0.4], [0.3], [0.1]]))
    found = scorer.expected(["ab"], np.array([[2.0]]))[:, 0]
    apart, joined = 0.2 / 0.5, 0.3 / 0.5
    assert np.allclose(found, [2 * apart, 2 * apart, 2 * joined, 0])


def test_predictions_and_hold_out(spark):
    rows = corpus()
    got = {r.doc_id: r for r in language.identify(documents(spark, rows), PIECES).collect()}
    assert all(got[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _, _ in rows)
    assert all(got[i].lang_pred == lang for i, _, lang in rows)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_are_not_looked_at(spark):
    rows = corpus()
    wrong = [(i, t, "zz" if zlib.crc32(str(i).encode()) % 4 == 2 else lang) for i, t, lang in rows]
    a = sorted(map(tuple, language.identify(documents(spark, rows), PIECES).collect()))
    b = sorted(map(tuple, language.identify(documents(spark, wrong), PIECES).collect()))
    assert a == b


def test_awkward_rows(spark):
    rows = [(r[0], r[1], "aa") for r in awkward()]
    model = language.learn(documents(spark, corpus()), PIECES)
    got = language.predict(documents(spark, rows), model).collect()
    assert len(got) == len(rows)
    undetermined = sorted([r.doc_id for r in got if r.lang_pred == "und"], key=repr)
    assert undetermined == sorted([d for d, t, _ in rows if not any(c.isalpha() for c in t or "")], key=repr)
    assert all(r.score == 0 for r in got if r.lang_pred == "und")


def test_without_labels_or_rows(spark):
    got = language.identify(documents(spark, [(1, "some text"), (2, None)]), PIECES).collect()
    assert {r.lang_pred for r in got} == {"und"}
    assert language.identify(documents(spark, []), PIECES).collect() == []


def test_marked_words():
    assert lattice.marked_words("a  b\nc") == ["▁a", "▁", "▁b", "\n", "c"]
