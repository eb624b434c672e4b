import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from ledgerloom.llm import bpe_stream, lattice, unigram_count
from tests.llm.helpers import awkward, documents, prose

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "it's 'LL Don't ''s", "\n", "a\n\nb", "日本語 テキスト 😀😀x", "<|endoftext|>hi <|startoftext|> there<|endoftext|>", "x\0y \0", "ΑΣ ΟΔΟΣ İ ﬁ é",
    "a\x1cb \x1d\x1e", "½ ² 12345 ٣", "▁x ▁", "<s> hi </s> <0x41>", "a" * 3001, "ab" * 900, "ha" * 999 + "h", "the" * 1500,
]


@pytest.fixture(scope="module")
def bpe():
    return bpe_stream.Bpe(bpe_stream.read_spec(WORD_BPE))


def odd_texts():
    rng = random.Random(5)
    bits = ["th", "an", "in", "er", "ing", "tion", "e", "a", "s", "-", "é", "日"]
    return ODD + ["".join(rng.choice(bits) for _ in range(rng.randint(1, 2500))) for _ in range(6)] + [prose(rng, 200)]


def test_bpe_equals_library(bpe):
    library = Tokenizer.from_file(WORD_BPE)
    texts = odd_texts()
    for text, ids in zip(texts, bpe.encode_many(texts)):
        expected = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected
        assert b"".join(bpe.decode(ids)).decode() == library.decode(expected, skip_special_tokens=False)


def test_transducer_with_a_short_buffer_equals_whole_words(bpe):
    rng = random.Random(6)
    for _ in range(3):
        word = "".join(rng.choice(["th", "er", "a", "n", "ing", "x"]) for _ in range(2500))
        symbols = list(bpe._symbols(word))
        tokens = list(bpe.transduce(iter(symbols)))
        assert tokens == bpe.merge(symbols)


def test_tokens_are_emitted_before_the_end(bpe):
    fed = []

    def feed():
        for symbol in bpe._symbols("ab" * 4000):
            fed.append(symbol)
            yield symbol

    first = next(iter(bpe.transduce(feed())))
    assert first and len(fed) <= 2 * bpe.lookahead + 64


def test_lookahead_by_hand():
    # (a b) then (c ab): a change after "cab" can reach back over a and then c.
    assert bpe_stream.sufficient_lookahead([("a", "b"), ("c", "ab")], "") == 2
    assert bpe_stream.sufficient_lookahead([("a", "b"), ("c", "d")], "") == 1


def test_unsuitable_merge_list_is_refused():
    spec = bpe_stream.read_spec(WORD_BPE)
    with pytest.raises(ValueError, match="lookahead"):
        bpe_stream.Bpe(spec._replace(merges=[*spec.merges, spec.merges[0]]))


def test_byte_machine_holds_back_broken_characters(bpe):
    machine = bpe_stream.ByteMachine(bpe)
    half = bpe.spec.ids[bpe.byte_symbol[0xC3]]
    rest = bpe.spec.ids[bpe.byte_symbol[0xA9] + "</w>"]
    assert machine.feed([half]) == b"" and machine.feed([rest]) == "é ".encode()
    assert machine.feed([half]) == b"" and machine.end() == "�".encode()
    text = "some words é 日本"
    machine = bpe_stream.ByteMachine(bpe)
    assert machine.feed(np.frombuffer(bpe.encode(text), "<u4").tolist()).decode() == text + " "


def test_bpe_table(spark, bpe):
    rows = awkward()
    got = bpe_stream.encode_table(documents(spark, rows), WORD_BPE, with_ids=True).collect()
    expected = []
    for doc, text in rows:
        ids = bpe.encode(text or "")
        expected.append((doc, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(b"".join(bpe.decode(ids))).hexdigest()))
    assert sorted([tuple(r)[:4] for r in got], key=repr) == sorted(expected, key=repr)
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert bpe_stream.encode_table(documents(spark, []), WORD_BPE).collect() == []


def test_counts_equal_library():
    vocabulary = lattice.sentencepiece_vocabulary(PIECES)
    library = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=True))
    library.pre_tokenizer = pre_tokenizers.Metaspace(prepend_scheme="always", split=True)
    counter, texts = unigram_count.Counter(vocabulary), odd_texts()
    scores = dict(vocabulary)
    for text, (score, tokens) in zip(texts, counter.totals(texts)):
        found = library.encode(text, add_special_tokens=False)
        assert tokens == len(found.ids)
        if not any(t.startswith("<0x") for t in found.tokens):
            assert score == sum(scores[t] for t in found.tokens)


def test_ties_take_the_longer_piece():
    counter = unigram_count.Counter([("a", -1.0), ("b", -1.0), ("ab", -2.0), ("▁", 0.0)])
    assert counter.totals(["ab"]) == [(-2.0, 2)]


def test_word_table_forgets(monkeypatch):
    monkeypatch.setattr(unigram_count, "WORDS_KEPT", 5)
    counter = unigram_count.Counter(lattice.sentencepiece_vocabulary(PIECES))
    texts = [prose(random.Random(i), 30) for i in range(5)]
    one_by_one = [counter.totals([t])[0] for t in texts]
    assert one_by_one == unigram_count.Counter(lattice.sentencepiece_vocabulary(PIECES)).totals(texts)


def test_count_table(spark):
    rows = awkward()
    got = {(r.doc_id, r.n_chars, r.n_tokens, r.score) for r in unigram_count.count_tokens(documents(spark, rows), PIECES).collect()}
    counter = unigram_count.Counter(lattice.sentencepiece_vocabulary(PIECES))
    assert got == {(d, len(t or ""), *reversed(counter.totals([t])[0])) for d, t in rows}
    assert unigram_count.count_tokens(documents(spark, []), PIECES).collect() == []


def test_every_code_point_is_split_as_the_library_splits_it():
    library = Tokenizer.from_file(WORD_BPE)
    bpe = bpe_stream.Bpe(bpe_stream.read_spec(WORD_BPE))
    odd = sorted(bpe.spec.stand_ins)
    assert odd
    # All points the two tables tell apart, and every point up to the end of the assigned letters.
    points = [p for p in range(0x33480) if not 0xD800 <= p < 0xE000] + [p for p in odd if p >= 0x33480]
    texts = []
    for at in range(0, len(points), 500):
        part = [chr(p) for p in points[at : at + 500]]
        texts += [" ".join(f"a{c}b" for c in part), " ".join(part), " ".join(f"1{c}{c.upper()}'s!" for c in part)]
    got = bpe.encode_many(texts)
    for text, mine, theirs in zip(texts, got, library.encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(mine, bpe_stream.ID_TYPE).tolist() == theirs.ids, text[:50]


def test_no_other_plane_has_code_points_that_differ():
    everything = ((0, 0xD800), (0xE000, 0x110000))
    assert bpe_stream.stand_ins(everything) == bpe_stream.stand_ins()
    assert bpe_stream.lowered(everything) == bpe_stream.lowered()
