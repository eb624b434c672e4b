"""Language identification by unigram pieces with the segmentation summed out.

Each language has a probability for every piece of a fixed public vocabulary. The
probability of a word is the sum over all its segmentations into pieces, which
the forward algorithm computes for all languages at once; the probability of a
text is the product over its words. The piece probabilities are learned by
expectation maximisation: the forward-backward algorithm gives how often a
piece is expected in the words of a language, over all segmentations.

Learning reads about ``docs_per_language`` labelled documents of each language
(those whose hash falls under a share that follows from the language's count)
and is spread over tasks; what comes back to the driver is one number per piece
and language. Prediction reads every text in full, and a worker keeps the
outcome for a bounded number of words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import only
from ledgerloom.llm.lattice import Vocabulary, WordTable, ends_of, in_portions, marked_words, sentencepiece_vocabulary
from ledgerloom.session import cut_lineage

UNDETERMINED = "und"
DOCS_PER_LANGUAGE = 400
#: The model holds the vocabulary once a language; a column with more values names something else, and learning stops.
LANGUAGES = 500
ROUNDS = 3
SMOOTHING = 0.1
# A character that is no piece: the same in all languages.
UNKNOWN = 1e-7
# Probabilities of segmentations shrink by about this factor a character.
PER_CHAR = 1e3
# After so many characters of a word the running sums are brought back to 1.
RESCALE_EVERY = 32
WORDS_KEPT = 300_000
PORTION = 2 << 20
_LETTER = re.compile(r"[^\W\d_]")


class Model(NamedTuple):
    pieces: list[str]
    languages: list[str]
    probability: np.ndarray  # (pieces + 1, languages); the last row is for unknown characters
    prior: np.ndarray


class Scorer:
    def __init__(self, pieces: list[str], probability: np.ndarray):
        self.vocabulary = Vocabulary(pieces)
        scale = PER_CHAR ** self.vocabulary.lengths.astype(np.float64)
        self.weight = probability * scale[:, None]
        self.words = WordTable(self.log_probability, WORDS_KEPT)

    def _forward(self, edges) -> tuple[np.ndarray, np.ndarray]:
        """Sums over the segmentations up to each node, and what was taken out of each word's sums, as a logarithm."""
        languages = self.weight.shape[1]
        alpha = np.zeros((edges.nodes, languages))
        alpha[edges.origin] = 1
        taken = np.zeros((len(edges.origin), languages))
        back = np.arange(self.vocabulary.longest)
        for step, (low, high) in enumerate(zip(edges.steps[:-1], edges.steps[1:]), 1):
            if low == high:
                continue
            first, ends = ends_of(edges, low, high)
            alpha[ends] = np.add.reduceat(alpha[edges.start[low:high]] * self.weight[edges.piece[low:high]], first, axis=0)
            if step % RESCALE_EVERY == 0:
                long = np.flatnonzero(edges.length > step)
                if len(long):
                    nodes = (edges.origin[long] + step)[:, None] - back[back < step]
                    largest = alpha[nodes].max(axis=1)
                    alpha[nodes] /= largest[:, None, :]
                    taken[long] += np.log(largest)
        return alpha, taken

    def log_probability(self, words: list[str]) -> np.ndarray:
        edges = self.vocabulary.edges(words)
        alpha, taken = self._forward(edges)
        return np.log(alpha[edges.origin + edges.length]) + taken - (edges.length * np.log(PER_CHAR))[:, None]

    def expected(self, words: list[str], counts: np.ndarray) -> np.ndarray:
        """Expected occurrences of each piece, ``counts`` being (words, languages)."""
        edges = self.vocabulary.edges(words)
        alpha, _ = self._forward(edges)
        beta = np.zeros_like(alpha)
        last = edges.origin + edges.length
        beta[last] = counts / alpha[last]
        through = np.zeros((len(self.weight), alpha.shape[1]))
        for low, high in zip(edges.steps[-2::-1], edges.steps[:0:-1]):
            if low == high:
                continue
            start, piece = edges.start[low:high], edges.piece[low:high]
            back = beta[edges.end[low:high]] * self.weight[piece]
            np.add.at(beta, start, back)
            np.add.at(through, piece, back * alpha[start])
        return through


def held_out(id_col: str = "doc_id", fold: int = 2) -> Column:
    """Documents nothing is learned from: CRC-32 of the id as text, modulo 4. A null id is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == fold, F.lit(True))


def learn(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", docs_per_language: int = DOCS_PER_LANGUAGE, rounds: int = ROUNDS) -> Model:
    """A model of the languages in ``lang_col`` from the documents that are not held out.

    Rows with a null language or text teach nothing. With no labelled text at
    all the model has no language and every prediction is undetermined.
    """
    spark = docs.sparkSession
    pieces = [p for p, _ in sentencepiece_vocabulary(vocabulary_path)]
    labelled = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    labelled = labelled.filter(~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counted = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(LANGUAGES + 1).collect()
    if len(counted) > LANGUAGES:
        raise ValueError(f"{lang_col} has more than {LANGUAGES} values: it names no languages")
    sizes = {r.lang: r.n for r in counted}
    languages = sorted(sizes)
    if not languages:
        return Model(pieces, [], np.zeros((len(pieces) + 1, 0)), np.zeros(0))
    limit = F.create_map(*[c for v, n in sizes.items() for c in (F.lit(v), F.lit(docs_per_language / n))])
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = labelled.filter(place < limit[F.col("lang")]).select("lang", "text")
    words = cut_lineage(sample.mapInArrow(_word_counts, "lang string, word string, n bigint").groupBy("word", "lang").agg(F.sum("n").alias("n")))
    probability = np.full((len(pieces) + 1, len(languages)), 1 / len(pieces))
    probability[-1] = UNKNOWN
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast((pieces, languages, probability))  # vocabulary times languages
        expected = words.mapInArrow(lambda b: _expected_counts(b, shared.value), "piece int, lang int, n double")
        summed = expected.groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.full((len(pieces), len(languages)), SMOOTHING)
        known = summed[summed["piece"] < len(pieces)]
        counts[known["piece"], known["lang"]] += known["n"]
        probability[:-1] = counts / counts.sum(axis=0)
    total = sum(sizes.values())
    return Model(pieces, languages, probability, np.log([sizes[v] / total for v in languages]))


def _word_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def packed():
        keys = list(counts)
        arrays = [pa.array([k[0] for k in keys]), pa.array([k[1] for k in keys]), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(arrays, ["lang", "word", "n"])

    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            name = lang.as_py()
            for word in marked_words(text.as_py().lower()):
                # A longer word teaches as several, so that learning needs no rescaling.
                for at in range(0, len(word), RESCALE_EVERY):
                    counts[name, word[at : at + RESCALE_EVERY]] += 1
            if len(counts) > 200_000:
                yield packed()
    if counts:
        yield packed()


def _expected_counts(batches: Iterator[pa.RecordBatch], model) -> Iterator[pa.RecordBatch]:
    pieces, languages, probability = model
    scorer, place = Scorer(pieces, probability), {v: i for i, v in enumerate(languages)}
    total = np.zeros_like(probability)
    for batch in batches:
        frame = batch.to_pydict()
        for at in range(0, batch.num_rows, 10_000):
            words = frame["word"][at : at + 10_000]
            counts = np.zeros((len(words), len(languages)))
            counts[np.arange(len(words)), [place[v] for v in frame["lang"][at : at + 10_000]]] = frame["n"][at : at + 10_000]
            total += scorer.expected(words, counts)
    piece, lang = np.nonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(piece, pa.int32()), pa.array(lang, pa.int32()), pa.array(total[piece, lang])], ["piece", "lang", "n"])


_last: list[tuple[object, Scorer]] = []


def _scorer(broadcast_id: int, model: Model) -> Scorer:
    """A worker process keeps its automaton and words from task to task of one prediction."""
    only(_last)
    if not _last or _last[0][0] != broadcast_id:
        _last[:] = [(broadcast_id, Scorer(model.pieces, model.probability))]
    return _last[0][1]


def _judged(scorer: Scorer, model: Model, texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The likeliest language of each text and its probability."""
    readable = [t if model.languages and t and _LETTER.search(t) else None for t in texts]
    codes = scorer.words.look_up([marked_words(t.lower()) if t else [] for t in readable])
    best, score = [], []
    for t, c in zip(readable, codes):
        if t is None:
            best.append(UNDETERMINED)
            score.append(0.0)
            continue
        likely = scorer.words.rows[c].sum(axis=0) + model.prior
        top = int(likely.argmax())
        best.append(model.languages[top])
        score.append(float(1 / np.exp(likely - likely[top]).sum()))
    return best, score


def with_language(docs: DataFrame, model: Model, name: str, text_col: str = "text") -> DataFrame:
    """All rows and columns, with the predicted language of each row's text in column ``name``; no row is moved."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key, place = shared._jbroadcast.id(), docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared.value)
        for batch in batches:
            found: list[str] = []
            for portion in in_portions((t.as_py() for t in batch.column(place)), lambda t: len(t or ""), PORTION):
                found.extend(_judged(scorer, shared.value, portion)[0])
            yield batch.append_column(name, pa.array(found, pa.string()))

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]))


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score.

    ``score`` is the probability of the predicted language given the text.
    Texts that are null or have no letter are ``und`` with score 0. Of equally
    likely languages the first by name is taken. Only the text is looked at.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = shared._jbroadcast.id()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(key, shared.value)
        for batch in batches:
            rows = ((i.as_py(), h.as_py(), t.as_py()) for i, h, t in zip(*batch.columns))
            for portion in in_portions(rows, lambda r: len(r[2] or ""), PORTION):
                ids, held, texts = zip(*portion)
                best, score = _judged(scorer, shared.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(best), pa.array(score, pa.float64())],
                    ["doc_id", "held_out", "lang_pred", "score"],
                )

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, "doc_id bigint, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learn from the labelled documents that are not held out, then predict all documents."""
    return predict(docs, learn(docs, vocabulary_path, id_col, text_col, lang_col), id_col, text_col)
