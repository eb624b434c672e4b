"""All segmentations of many words into vocabulary pieces, as one array of edges.

An Aho-Corasick automaton lists every piece that occurs in the words. The words
are then walked side by side: step d handles the edges of all words that end at
their d-th character, so a step is a few array operations however many words
there are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice
from typing import NamedTuple

import ahocorasick
import numpy as np

WORD_MARK = "▁"
_BETWEEN = "\0"
_FOUND = np.dtype([("last", np.int32), ("piece", np.int32)])


def sentencepiece_vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a SentencePiece model file, by id."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Edges(NamedTuple):
    """Edges sorted by step, end and start. Node 0 of word w is ``origin[w]``; its last is ``origin[w] + length[w]``."""

    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    origin: np.ndarray
    length: np.ndarray
    steps: np.ndarray  # edges of step d + 1 are steps[d]:steps[d + 1]
    nodes: int
    text: str


class Vocabulary:
    """The automaton over the pieces. A character that is no piece itself gets an edge with piece number ``len(pieces)``."""

    def __init__(self, pieces: Sequence[str]):
        self.size = len(pieces)
        self.lengths = np.array([len(p) for p in pieces] + [1], np.int32)
        self.longest = int(self.lengths.max())
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for number, piece in enumerate(pieces):
            self.automaton.add_word(piece, number)
        self.automaton.make_automaton()

    def edges(self, words: Sequence[str]) -> Edges:
        text = _BETWEEN.join(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        origin = np.concatenate(([0], np.cumsum(length + 1)))
        nodes, origin = int(origin[-1]), origin[:-1]
        found = np.fromiter(self.automaton.iter(text), _FOUND)
        piece = found["piece"]
        end = found["last"].astype(np.int64) + 1
        start = end - self.lengths[piece]
        bare = np.ones(nodes, bool)
        bare[origin + length] = False
        bare[start[end - start == 1]] = False
        alone = np.flatnonzero(bare)
        start = np.concatenate((start, alone))
        end = np.concatenate((end, alone + 1))
        piece = np.concatenate((piece, np.full(len(alone), self.size, np.int32)))
        step = end - np.repeat(origin, length + 1)[start]
        order = np.lexsort((start, end, step))
        steps = np.searchsorted(step[order], np.arange(1, (int(length.max()) if len(words) else 0) + 2))
        return Edges(start[order], end[order], piece[order], origin, length, steps, nodes, text)


def ends_of(edges: Edges, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """For the edges of a step: where each end's edges begin, and the ends."""
    ends = edges.end[low:high]
    first = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1])))
    return first, ends[first]


class WordTable:
    """Per-word results kept between texts, forgotten all at once when there are ``most`` of them."""

    def __init__(self, compute: Callable[[list[str]], np.ndarray], most: int, at_once: int = 20_000):
        self.compute, self.most, self.at_once = compute, most, at_once
        self.forget()

    def forget(self) -> None:
        table = self

        class Numbers(dict):
            def __missing__(self, word):
                self[word] = number = len(self)
                table.new.append(word)
                return number

        self.numbers, self.new, self.rows, self.known = Numbers(), [], None, 0

    def look_up(self, texts_words: Sequence[Sequence[str]]) -> list[np.ndarray]:
        """Word numbers of each text; afterwards ``rows`` holds the results by number."""
        if len(self.numbers) > self.most:
            self.forget()
        number = self.numbers.__getitem__
        codes = [np.fromiter(map(number, words), np.int64, len(words)) for words in texts_words]
        fresh = iter(self.new)
        while batch := list(islice(fresh, self.at_once)):
            self._keep(self.compute(batch))
        self.new = []
        return codes

    def _keep(self, rows: np.ndarray) -> None:
        if self.rows is None:
            self.rows = np.empty((max(4096, len(rows)), *rows.shape[1:]), rows.dtype)
        while self.known + len(rows) > len(self.rows):
            self.rows = np.concatenate((self.rows, np.empty_like(self.rows)))
        self.rows[self.known : self.known + len(rows)] = rows
        self.known += len(rows)


def in_portions(rows: Iterator[tuple], size_of: Callable[[tuple], int], most: int) -> Iterator[list[tuple]]:
    """Rows in lists of about ``most`` characters."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += size_of(row)
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def marked_words(text: str) -> list[str]:
    """A text cut where no piece can cross: before every word mark, around every line end.

    Blanks are word marks, and a text that does not begin with one gets one.
    """
    marked = text.replace(" ", WORD_MARK)
    if not marked.startswith(WORD_MARK):
        marked = WORD_MARK + marked
    return [w for w in marked.replace(WORD_MARK, " " + WORD_MARK).replace("\n", " \n ").split(" ") if w]
