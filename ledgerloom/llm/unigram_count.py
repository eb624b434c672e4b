"""Token counts under a unigram vocabulary, without building the tokens.

Dynamic programming over the pieces that an Aho-Corasick automaton finds carries
the best score and the number of pieces to every character. Of equal scores the
piece that starts first wins, which is the order in which the tokenizers library
fills its lattice. A character that is no piece scores the lowest piece score
less ten and counts as its UTF-8 bytes (byte fallback).

Words are independent (no piece reaches over a blank or a line end), so a
worker keeps the outcome per word, for a bounded number of words. The public
vocabulary's scores are whole numbers, so sums and ties are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.lattice import Vocabulary, WordTable, ends_of, in_portions, marked_words, sentencepiece_vocabulary

UNKNOWN_PENALTY = 10.0
WORDS_KEPT = 400_000
PORTION = 2 << 20


class Counter:
    def __init__(self, pieces: list[tuple[str, float]]):
        self.vocabulary = Vocabulary([p for p, _ in pieces])
        scores = np.array([s for _, s in pieces], np.float64)
        self.scores = np.append(scores, scores.min() - UNKNOWN_PENALTY)
        self.words = WordTable(self.best, WORDS_KEPT)

    def best(self, words: list[str]) -> np.ndarray:
        """Best score and number of tokens of each word."""
        edges = self.vocabulary.edges(words)
        best, count = np.full(edges.nodes, -np.inf), np.zeros(edges.nodes, np.int64)
        best[edges.origin] = 0
        tokens = np.ones(len(edges.piece), np.int64)
        unknown = edges.piece == self.vocabulary.size
        text = edges.text
        tokens[unknown] = [len(text[i].encode("utf-8", "surrogatepass")) for i in edges.start[unknown]]
        weight = self.scores[edges.piece]
        for low, high in zip(edges.steps[:-1], edges.steps[1:]):
            if low == high:
                continue
            first, ends = ends_of(edges, low, high)
            reached = best[edges.start[low:high]] + weight[low:high]
            most = np.maximum.reduceat(reached, first)
            # The first edge of an end that reaches its maximum: edges are in order of their start.
            at = np.flatnonzero(reached == np.repeat(most, np.diff(np.append(first, high - low))))
            chosen = low + at[np.searchsorted(at, first)]
            best[ends] = most
            count[ends] = count[edges.start[chosen]] + tokens[chosen]
        last = edges.origin + edges.length
        return np.stack((best[last], count[last].astype(np.float64)), axis=1)

    def totals(self, texts: list[str | None]) -> list[tuple[float, int]]:
        codes = self.words.look_up([marked_words(t) if t else [] for t in texts])
        rows = self.words.rows
        out = []
        for c in codes:
            score, tokens = rows[c].sum(axis=0) if len(c) else (0.0, 0)
            out.append((float(score), int(tokens)))
        return out


_last: list[tuple[list, Counter]] = []


def _counter(pieces: list[tuple[str, float]]) -> Counter:
    """A worker process keeps its automaton and words from task to task."""
    if not _last or _last[0][0] != pieces:
        _last[:] = [(pieces, Counter(pieces))]
    return _last[0][1]


def count_tokens(docs: DataFrame, vocabulary_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars, n_tokens, score.

    Null and empty texts have no token and score 0. Rows are independent, so
    repeated rows and null ids pass through; other columns are not carried.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast(sentencepiece_vocabulary(vocabulary_path))  # as long as the vocabulary file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(shared.value)
        for batch in batches:
            rows = zip(batch.column(0), batch.column(1))
            for portion in in_portions(rows, lambda r: len(r[1].as_py() or ""), PORTION):
                texts = [t.as_py() for _, t in portion]
                totals = counter.totals(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([i.as_py() for i, _ in portion], pa.int64()),
                        pa.array([len(t or "") for t in texts], pa.int64()),
                        pa.array([n for _, n in totals], pa.int64()),
                        pa.array([s for s, _ in totals], pa.float64()),
                    ],
                    ["doc_id", "n_chars", "n_tokens", "score"],
                )

    rows = docs.select(F.col(id_col).cast("bigint"), F.col(text_col).cast("string"))
    return rows.mapInArrow(run, "doc_id bigint, n_chars bigint, n_tokens bigint, score double")
