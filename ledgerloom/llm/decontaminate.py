"""Benchmark decontamination by latent semantic retrieval.

Passages are TF-IDF vectors over hashed terms. A randomised singular value
decomposition of all passages of the corpus and of the benchmark gives a latent
space: a block that spans the benchmark's own leading directions is multiplied
with the matrix and its transpose, spread over the tasks that read the corpus,
and the space follows from the block and its product (Nystroem). Document
frequencies are counted over the whole corpus as well.

Every document is then read in full. Items of whose words half are nowhere in
it cannot be found and are set aside. For the others, windows of about the
length of an item are projected, and windows whose cosine with an item reaches
``cosine`` are candidates. For these the longest common subsequence of words
between the item and the text around the window decides: nearly all of the item
is a verbatim copy; half of it is a paraphrase if the answer is there too, that
is the item's rarest words.

All per-document work stays in the task that reads the document; nothing is
shuffled but counts and partial products. Items go in blocks of at most
``ITEMS_AT_ONCE``, so what is broadcast has a fixed bound.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import only
from ledgerloom.session import cut_lineage

TERMS = 1 << 14
DIMENSIONS = 64
OVERSAMPLE = 8
POWER_ROUNDS = 2
FIT_WORDS = 32
# Passages multiplied at a time: their part of the matrix stays in a core's cache.
FIT_PASSAGES = 64
# A corpus of any size weighs like one of this many documents, or benchmark passages would count for nothing in a large one.
CORPUS_WEIGHT = 1000
# Terms whose sums travel together.
BAND = 64
# Benchmark passages weigh this much in the decomposition, so that the space holds what sets them apart.
ITEM_WEIGHT = 20.0
ITEMS_AT_ONCE = 4096
# Low enough for items with replaced words among thousands of others that share the space.
COSINE = 0.5
VERBATIM = 0.8
PARAPHRASE = 0.5
ANSWER_WORDS = 3
SHORTEST_WINDOW = 8
WINDOWS_AT_ONCE = 1024
WORDS_KEPT = 400_000

_WORD = re.compile(r"[^\W_]+")


class _Terms(dict):
    def __missing__(self, word: str) -> int:
        self[word] = term = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass")) % TERMS
        return term


_terms = _Terms()


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def terms_of(words: list[str]) -> np.ndarray:
    only(_terms)
    if len(_terms) > WORDS_KEPT:
        _terms.clear()
    return np.fromiter(map(_terms.__getitem__, words), np.int64, len(words))


class Item(NamedTuple):
    item_id: int
    words: list[str]
    answer: frozenset[str]


class Index(NamedTuple):
    """What a task needs: weighted term vectors and, by window length, the items' unit vectors."""

    terms: np.ndarray  # (TERMS + 1, dimensions); the last row is for padding
    items: dict[int, tuple[list[Item], np.ndarray]]
    words: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # the terms of all items' words, where each item's begin, and how many a leak needs


# --- learning ----------------------------------------------------------------------------------


def with_terms(rows: DataFrame) -> DataFrame:
    """Rows with the terms of their last column, a text, as 16-bit numbers in the order of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            terms = [terms_of(words_of(text.as_py())).astype("<u2").tobytes() for text in batch.column(batch.num_columns - 1)]
            yield batch.append_column("terms", pa.array(terms, pa.binary()))

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField("terms", T.BinaryType())]))


def _stored(terms: pa.BinaryScalar) -> np.ndarray:
    return np.frombuffer(terms.as_buffer(), "<u2").astype(np.int64)


def document_frequencies(texts: DataFrame) -> tuple[np.ndarray, int]:
    """Number of documents with each term, over all of them, and the number of documents."""
    return _frequencies(with_terms(texts).select("terms"))


def _frequencies(terms: DataFrame) -> tuple[np.ndarray, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, rows = np.zeros(TERMS, np.int64), 0
        for batch in batches:
            for found in batch.column(0):
                there = np.zeros(TERMS, bool)
                there[_stored(found)] = True
                counts += there
            rows += batch.num_rows
        seen = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(counts[seen], rows))], ["term", "n"])

    found = terms.mapInArrow(run, "term int, n bigint").groupBy("term").agg(F.sum("n").alias("n")).toPandas()  # one row a term
    out = np.zeros(TERMS + 1, np.int64)
    out[found["term"]] = found["n"]  # -1: the number of documents
    return out[:-1], int(out[-1])


def _passages(terms: np.ndarray, length: int) -> Iterator[np.ndarray]:
    for at in range(0, len(terms), length):
        yield terms[at : at + length]


def gram_times(passages: list[np.ndarray], idf: np.ndarray, block: np.ndarray) -> np.ndarray:
    """AᵀA times ``block`` for the matrix A of the passages, whose rows are unit TF-IDF vectors."""
    out = np.zeros(block.shape, block.dtype)
    place = np.zeros(TERMS, np.int64)
    for at in range(0, len(passages), FIT_PASSAGES):
        some = passages[at : at + FIT_PASSAGES]
        terms = np.concatenate(some)
        place[terms] = 1
        seen = np.flatnonzero(place)
        place[seen] = np.arange(len(seen))
        cells = np.repeat(np.arange(len(some)) * len(seen), [len(p) for p in some]) + place[terms]
        place[seen] = 0
        weights = np.bincount(cells, minlength=len(some) * len(seen)).reshape(len(some), -1) * idf[seen]
        weights /= np.maximum(np.linalg.norm(weights, axis=1, keepdims=True), 1e-12)
        weights = weights.astype(block.dtype, copy=False)
        out[seen] += weights.T @ (weights @ block[seen])
    return out


def latent_space(texts: DataFrame, item_passages: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    """Leading right singular vectors (TERMS, at most DIMENSIONS) of the passages of all texts and of the items."""
    return _space(with_terms(texts).select("terms"), item_passages, idf)


def _space(terms: DataFrame, item_passages: list[np.ndarray], idf: np.ndarray) -> np.ndarray:
    start = np.random.default_rng(7).standard_normal((TERMS, DIMENSIONS + OVERSAMPLE))
    block = np.linalg.qr(start)[0]
    for _ in range(POWER_ROUNDS):
        # A little of the random block takes the place of directions that few items leave open.
        block = np.linalg.qr(gram_times(item_passages, idf, block) + 1e-6 * start)[0]
    product, documents = _corpus_product(terms, idf, block)
    product *= min(1.0, CORPUS_WEIGHT / max(documents, 1))
    product += ITEM_WEIGHT**2 * gram_times(item_passages, idf, block)
    inner = block.T @ product
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    firm = values > 1e-6 * values[-1]  # partial products have the precision of 32 bits
    vectors, sizes, _ = np.linalg.svd(product @ (vectors[:, firm] / np.sqrt(values[firm])), full_matrices=False)
    return vectors[:, :DIMENSIONS]


def _corpus_product(terms: DataFrame, idf: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, int]:
    """AᵀA times ``block`` for all passages of the corpus, and the number of documents. Tasks' sums are added up band by band of terms."""
    shared = terms.sparkSession.sparkContext.broadcast((idf.astype(np.float32), block.astype(np.float32)))

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, now = shared.value
        total, rows, passages = np.zeros(now.shape), 0, []
        for batch in batches:
            rows += batch.num_rows
            for found in batch.column(0):
                passages += _passages(_stored(found), FIT_WORDS)
                if len(passages) >= FIT_PASSAGES:
                    total += gram_times(passages, weights, now)
                    passages = []
        total += gram_times(passages, weights, now)
        bands = [b for b in range(TERMS // BAND) if total[b * BAND : (b + 1) * BAND].any()]
        parts = [total[b * BAND : (b + 1) * BAND].astype("<f4").tobytes() for b in bands]
        yield pa.RecordBatch.from_arrays([pa.array([-1, *bands], pa.int32()), pa.array([b"", *parts], pa.binary()), pa.array([rows] + [0] * len(bands))], ["band", "part", "n"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        rows: dict[int, int] = defaultdict(int)
        for batch in batches:
            for band, part, n in zip(*(batch.column(i) for i in range(3))):
                band = band.as_py()
                rows[band] += n.as_py()
                sums[band] = sums.get(band, 0.0) + np.frombuffer(part.as_buffer(), "<f4").astype(float)
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array([s.tobytes() for s in sums.values()], pa.binary()), pa.array([rows[b] for b in sums], pa.int64())], ["band", "part", "n"])

    schema = "band int, part binary, n bigint"
    out, documents = np.zeros(block.shape), 0
    for row in terms.mapInArrow(multiply, schema).repartition("band").mapInArrow(add, schema).toLocalIterator():  # one row a band
        documents += row.n
        if row.band >= 0:
            out[row.band * BAND : (row.band + 1) * BAND] = np.frombuffer(row.part).reshape(BAND, -1)
    shared.destroy()
    return out, documents


def window_length(words: int) -> int:
    """The largest power of two that is not longer than the item."""
    return max(SHORTEST_WINDOW, 1 << (words.bit_length() - 1))


def build_index(items: list[Item], space: np.ndarray, idf: np.ndarray) -> Index:
    terms = np.vstack((idf[:, None] * space, np.zeros((1, space.shape[1])))).astype(np.float32)
    by_length: dict[int, list[Item]] = defaultdict(list)
    for item in items:
        by_length[window_length(len(item.words))].append(item)
    made, words = {}, {}
    for length, group in sorted(by_length.items()):
        theirs = [terms_of(i.words) for i in group]
        vectors = np.stack([terms[of].sum(axis=0) for of in theirs])
        made[length] = group, vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        sizes = np.array([len(of) for of in theirs])
        words[length] = np.concatenate(theirs), np.cumsum(sizes) - sizes, PARAPHRASE * sizes
    return Index(terms, made, words)


def possible(terms: np.ndarray, index: Index) -> dict[int, np.ndarray]:
    """By window length, the items that have half of their words in the text, as places in the index; no other can be found in it."""
    there = np.zeros(TERMS, np.int64)
    there[terms] = 1
    held = {length: np.flatnonzero(np.add.reduceat(there[words], starts) >= least) for length, (words, starts, least) in index.words.items()}
    return {length: some for length, some in held.items() if len(some)}


# --- searching ---------------------------------------------------------------------------------


def candidates(terms: np.ndarray, index: Index, cosine: float) -> Iterator[tuple[Item, int, float]]:
    """(item, first word of the window, cosine) of the windows that reach the cosine."""
    for item, starts, likeness in _near(terms, index, cosine):
        yield from ((item, at, like) for at, like in zip(starts.tolist(), likeness.tolist()))


def _near(terms: np.ndarray, index: Index, cosine: float, among: dict[int, np.ndarray] | None = None) -> Iterator[tuple[Item, np.ndarray, np.ndarray]]:
    """The same by item, as arrays in the order of the windows; an item may come again for later windows of a long text.

    ``among`` names the items to look for, by window length; without it, all are.
    """
    if not len(terms) or not index.items or (among is not None and not among):
        return
    base = min(index.items) // 2
    padded = np.full(-(-len(terms) // base) * base, TERMS)
    padded[: len(terms)] = terms
    blocks = np.concatenate([index.terms[padded[at : at + 4096 * base]].reshape(-1, base, index.terms.shape[1]).sum(axis=1) for at in range(0, len(padded), 4096 * base)])
    stride = base
    for length, (items, vectors) in index.items.items():
        while stride < length // 2:
            if len(blocks) % 2:
                blocks = np.vstack((blocks, np.zeros_like(blocks[:1])))
            blocks, stride = blocks[0::2] + blocks[1::2], stride * 2
        if among is not None:
            if length not in among:
                continue
            items, vectors = [items[i] for i in among[length].tolist()], vectors[among[length]]
        windows = blocks[:-1] + blocks[1:] if len(blocks) > 1 else blocks
        windows = windows / np.maximum(np.linalg.norm(windows, axis=1, keepdims=True), 1e-12)
        for at in range(0, len(windows), 4096):
            likeness = windows[at : at + 4096] @ vectors.T
            i, w = np.nonzero((likeness >= cosine).T)
            cuts = np.flatnonzero(np.diff(i)) + 1
            for of, here in zip(np.split(i, cuts), np.split(w, cuts)):
                if len(of):
                    yield items[of[0]], (at + here) * stride, likeness[here, of[0]]


def common_subsequence(item: list[str], text: list[str]) -> int:
    """Length of the longest common subsequence, 64 or more item words at a time in one number."""
    places: dict[str, int] = {}
    for i, word in enumerate(item):
        places[word] = places.get(word, 0) | 1 << i
    all_ones = row = (1 << len(item)) - 1
    for word in text:
        match = places.get(word)
        if match:
            kept = row & match
            row = ((row + kept) | (row - kept)) & all_ones
    return len(item) - row.bit_count()


class _Places:
    """The words of a text as numbers, and for each word the place where it occurred before."""

    def __init__(self, words: list[str]):
        self.number = {word: i for i, word in enumerate(dict.fromkeys(words))}
        self.words = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        order = np.argsort(self.words, kind="stable")
        self.before = np.full(len(words), -1)
        again = self.words[order][1:] == self.words[order][:-1]
        self.before[order[1:][again]] = order[:-1][again]

    def with_enough(self, item: Item, starts: np.ndarray, likeness: np.ndarray) -> Iterator[tuple[int, float]]:
        """Windows with half of the item's words around them: no common subsequence is longer than the words that are there at all."""
        n, known = len(item.words), [i for i in map(self.number.get, item.words) if i is not None]
        least = PARAPHRASE * n
        if len(known) < least:
            return
        times = np.bincount(known, minlength=len(self.number))[self.words]
        upto = np.concatenate(([0], np.cumsum(times)))
        low, high = np.maximum(starts - n, 0), np.minimum(starts + window_length(n) + n, len(times))
        # First by all places that hold a word of the item, then by the words they hold, each once.
        some = np.flatnonzero(upto[high] - upto[low] >= least)
        for at in range(0, len(some), WINDOWS_AT_ONCE):
            part = some[at : at + WINDOWS_AT_ONCE]
            first = low[part][:, None]
            place = first + np.arange(window_length(n) + 2 * n)
            inside = np.minimum(place, len(times) - 1)
            held = (times[inside] * ((self.before[inside] < first) & (place < high[part][:, None]))).sum(axis=1)
            yield from ((int(starts[i]), float(likeness[i])) for i in part[held >= least].tolist())


def leaks(text: str | None, index: Index, cosine: float = COSINE, terms: np.ndarray | None = None) -> list[tuple[int, int, float, float, str]]:
    """(item id, first word of the window, cosine, share of the item's words, kind) of the items a text holds; ``terms`` are those of its words if known."""
    if terms is None:
        terms = terms_of(words_of(text))
    best: dict[int, tuple[int, int, float, float, str]] = {}
    near = list(_near(terms, index, cosine, possible(terms, index)))
    if not near:
        return []
    words = words_of(text)
    places = _Places(words)
    for item, at, likeness in ((item, *window) for item, starts, like in near for window in places.with_enough(item, starts, like)):
        n = len(item.words)
        around = words[max(0, at - n) : at + window_length(n) + n]
        present = set(around)
        share = common_subsequence(item.words, around) / n
        if share >= VERBATIM:
            kind = "verbatim"
        elif share >= PARAPHRASE and item.answer <= present:
            kind = "paraphrase"
        else:
            continue
        found = item.item_id, at, likeness, share, kind
        if item.item_id not in best or (share, likeness, -at) > (best[item.item_id][3], best[item.item_id][2], -best[item.item_id][1]):
            best[item.item_id] = found
    return [best[i] for i in sorted(best)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", cosine: float = COSINE) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, start_word, cosine, share, kind.

    Documents without a leak have no row; null and empty texts have none. Items
    with a null id or without words are not searched for; items that repeat are
    searched for once each and reported once by id. A repeated document is
    reported as often as it is there. Other columns are not carried.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Words are told apart once; learning and searching read their terms.
    rows = cut_lineage(with_terms(rows))
    frequencies, n = _frequencies(rows.select("terms"))
    idf = np.log((1 + n) / (1 + frequencies)) + 1e-3
    schema = "doc_id bigint, item_id bigint, start_word bigint, cosine double, share double, kind string"
    searched = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text").cast("string").alias("text"))
    # Equal items would meet in one block, whose bound holds for different ones.
    searched = cut_lineage(searched.filter("item_id IS NOT NULL AND text IS NOT NULL").distinct())
    blocks = -(-searched.count() // (ITEMS_AT_ONCE // 2)) or 1
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        some = searched.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).orderBy("item_id", "text").collect()
        items = [_item(r.item_id, found, idf) for r in some if (found := words_of(r.text))]
        if not items:
            continue
        space = _space(rows.select("terms"), [terms_of(i.words) for i in items], idf)
        shared = spark.sparkContext.broadcast(build_index(items, space, idf))
        out = out.unionByName(rows.mapInArrow(lambda b, s=shared: _search(b, s.value, cosine), schema))
    return out


def _item(item_id: int, words: list[str], idf: np.ndarray) -> Item:
    rarest = sorted(set(words), key=lambda w: (-idf[_terms[w]], w))[:ANSWER_WORDS]
    return Item(item_id, words, frozenset(rarest))


def _search(batches: Iterator[pa.RecordBatch], index: Index, cosine: float) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
    names = ["doc_id", "item_id", "start_word", "cosine", "share", "kind"]
    for batch in batches:
        found = [(doc.as_py(), *leak) for doc, text, terms in zip(*batch.columns) for leak in leaks(text.as_py(), index, cosine, _stored(terms))]
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found), types)], names)
