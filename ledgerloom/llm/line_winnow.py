"""Repeated passages of whole lines, found by winnowing line hashes.

The unit is a line that is not blank, compared without the blanks around it. A
window is a shortest stretch of consecutive lines with at least ``min_words``
words, one for each line it may begin with and one for each it may end with. Of
every window the line with the least hash (the last of equals) is selected as a
fingerprint. Two passages that agree over a window select the same line of it,
so a shared passage of ``min_words`` words or more always shares a fingerprint,
and only windows around a fingerprint that occurs at a second place go on.

Positions are then joined by fingerprint and window: the first occurrence of a
window in (doc_id, text hash, line) order is kept, later ones are matches. As
windows reach both forwards and backwards from each line, the union of the
matched ones extends a match to both ends of the agreeing passage, without
pairing documents with one another: a window links to its first occurrence only,
however often it occurs.

A passage that begins and ends inside a line need not hold ``min_words`` words
of whole lines. So in what is left, words are winnowed as well, whatever the
lines: of every ``PASSAGE_WORDS`` words in a row at least one run of ``RUN_WORDS``
is selected, all stretches of ``PASSAGE_WORDS`` words around a run that occurs at
a second place are compared, and those that were there before are deleted word
by word. Overlapping stretches extend a match to its first and last word.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import fresh, only
from ledgerloom.session import cut_lineage, released_scratch

MIN_WORDS = 25
# Repeated passages of this many words, that is over 50, go wherever they begin and end.
PASSAGE_WORDS = 51
RUN_WORDS = 26
WORDS_KEPT = 300_000

_WORD = re.compile(r"\S+")
_U64 = np.uint64


def line_units(text: str) -> tuple[list[int], list[bytes], np.ndarray]:
    """Lines that are not blank: their numbers, 128-bit digests and word counts."""
    numbers, digests, words = [], [], []
    for number, line in enumerate(text.split("\n")):
        found = len(line.split())
        if found:
            numbers.append(number)
            digests.append(xxhash.xxh3_128_digest(line.strip().encode("utf-8", "surrogatepass")))
            words.append(found)
    return numbers, digests, np.array(words, np.int64)


def windows(words: np.ndarray, min_words: int) -> np.ndarray:
    """Shortest stretches (first, last) of ``min_words`` words: from every line on, and up to every line."""
    total = np.concatenate(([0], np.cumsum(words)))
    n = len(words)
    last = np.searchsorted(total, total[:-1] + min_words) - 1
    forward = np.stack((np.arange(n), last), axis=1)[last < n]
    first = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    backward = np.stack((first, np.arange(n)), axis=1)[first >= 0]
    return np.unique(np.concatenate((forward, backward)), axis=0)


def _windows_of(text: str, min_words: int) -> Iterator[tuple[int, int, int, bytes, int]]:
    """(fingerprint, first, last, window digest, fingerprint's place) of each window."""
    _, digests, words = line_units(text)
    if not len(words) or words.sum() < min_words:
        return
    hashes = np.frombuffer(b"".join(digests), np.int64)[::2]
    for first, last in windows(words, min_words).tolist():
        part = hashes[first : last + 1]
        at = last - int(part[::-1].argmin())
        digest = digests[first] if first == last else xxhash.xxh3_128_digest(b"".join(digests[first : last + 1]))
        yield int(hashes[at]), first, last, digest, at


def find_windows(docs: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Windows of all documents; a row is known by its id and the hash of its text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "row_hash", "fingerprint", "first", "last", "window", "place"]
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32()]

        def packed(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            rows = []
            for doc, row_hash, text in zip(*batch.columns):
                identity = doc.as_py(), row_hash.as_py()
                for found in _windows_of(text.as_py() or "", min_words):
                    rows.append(identity + found)
                    if len(rows) >= 20_000:
                        yield packed(rows)
                        rows = []
            if rows:
                yield packed(rows)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, row_hash bigint, fingerprint bigint, first int, last int, window binary, place int")


def repeated_stretches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, row_hash and the stretches (first, last) of lines, counted without blank ones, that repeat an earlier passage."""
    found = cut_lineage(find_windows(docs, id_col, text_col, min_words))
    position = F.struct("doc_id", "row_hash", "place")
    anchors = found.groupBy("fingerprint").agg(F.min(position).alias("a"), F.max(position).alias("b")).filter(F.col("a") != F.col("b"))
    # Stored, so that both sides of the join come from a shuffle and a hot fingerprint's rows can be split.
    near = found.join(cut_lineage(anchors.select("fingerprint")), "fingerprint", "left_semi")
    occurrence = F.struct("doc_id", "row_hash", "first")
    starts = near.groupBy("window").agg(F.min(occurrence).alias("kept"), F.max(occurrence).alias("other")).filter(F.col("kept") != F.col("other"))
    starts = cut_lineage(starts.select("window", "kept"))
    later = near.join(starts, "window").filter(occurrence != F.col("kept"))
    # A passage that overlaps its own first occurrence loses only what lies behind that.
    same_row = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("row_hash") == F.col("kept.row_hash"))
    behind = F.greatest(F.col("first"), F.col("kept.first") + (F.col("last") - F.col("first")) + 1)
    stretch = F.struct(F.when(same_row, behind).otherwise(F.col("first")).alias("first"), F.col("last"))
    # At most two windows a line, so a list is bounded by its document.
    return later.groupBy("doc_id", "row_hash").agg(F.collect_list(stretch).alias("stretches"))


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_hashes = _WordHashes()


def word_hashes(text: str | None) -> np.ndarray:
    words = (text or "").split()
    only(_hashes)
    if len(_hashes) > WORDS_KEPT:
        _hashes.clear()
    return np.fromiter(map(_hashes.__getitem__, words), _U64, len(words))


def selected_runs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and first words of the selected runs: of ``PASSAGE_WORDS`` words in a row the run with the least hash (the last of equals)."""
    n, span = len(words) - RUN_WORDS + 1, PASSAGE_WORDS - RUN_WORDS + 1
    if n < span:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    runs, done = np.zeros(n, _U64), 0
    # Hashes of 1, 2, 4, ... words; a run is put together from those its length is the sum of.
    part, length = words, 1
    factor = 0x9E3779B97F4A7C15
    while length <= RUN_WORDS:
        if RUN_WORDS & length:
            runs = runs * _U64(pow(factor, length, 1 << 64)) + part[done : done + n]
            done += length
        part = part[:-length] * _U64(pow(factor, length, 1 << 64)) + part[length:]
        length *= 2
    runs ^= runs >> _U64(32)
    runs *= _U64(0xD6E8FEB86659FD93)
    runs = (runs ^ (runs >> _U64(32))).view(np.int64)
    places = np.unique(_least_places(runs, span))
    return runs[places], places


def _least_places(values: np.ndarray, span: int) -> np.ndarray:
    """The place of the least value (the last of equals) in each stretch of ``span``."""
    least, length = np.arange(len(values)), 1
    while length < span:
        step = min(length, span - length)
        here, there = least[:-step], least[step:]
        least = np.where(values[there] <= values[here], there, here)
        length += step
    return least


_IDENTITY = ["doc_id", "row_hash", "text"]


def _find_runs(rows: DataFrame) -> DataFrame:
    """Selected runs of all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, row_hash, text in zip(*batch.columns):
                found, places = selected_runs(word_hashes(text.as_py()))
                if len(found):
                    identity = [pa.repeat(doc, len(found)), pa.repeat(row_hash, len(found))]
                    yield pa.RecordBatch.from_arrays([*identity, pa.array(found), pa.array(places, pa.int32())], ["doc_id", "row_hash", "run", "place"])

    return rows.select(*_IDENTITY).mapInArrow(run, "doc_id bigint, row_hash bigint, run bigint, place int")


def _find_passages(rows: DataFrame) -> DataFrame:
    """Stretches of ``PASSAGE_WORDS`` words that hold a run at one of ``places``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, row_hash, text, places in zip(*batch.columns):
                words = word_hashes(text.as_py())
                around = np.array(places.as_py(), np.int64)[:, None] - np.arange(PASSAGE_WORDS - RUN_WORDS + 1)
                first = np.unique(around[(around >= 0) & (around + PASSAGE_WORDS <= len(words))])
                digests = [xxhash.xxh3_128_digest(words[at : at + PASSAGE_WORDS].tobytes()) for at in first.tolist()]
                identity = [pa.repeat(doc, len(first)), pa.repeat(row_hash, len(first))]
                yield pa.RecordBatch.from_arrays([*identity, pa.array(first, pa.int32()), pa.array(digests, pa.binary())], ["doc_id", "row_hash", "first", "passage"])

    return rows.select(*_IDENTITY, "places").mapInArrow(run, "doc_id bigint, row_hash bigint, first int, passage binary")


def repeated_words(rows: DataFrame) -> DataFrame:
    """doc_id, row_hash and the stretches (first, last) of words that repeat an earlier passage of ``PASSAGE_WORDS`` words, for rows of doc_id, row_hash and text."""
    with released_scratch(rows.sparkSession) as keep:
        found = cut_lineage(_find_runs(rows))
        # Runs that occur once need no more than to be counted; whether places differ is for the passages to say.
        shared = found.groupBy("run").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)
        near = found.join(cut_lineage(shared.select("run")), "run", "left_semi")
        # Places of one document, so a list is bounded by it.
        places = keep(near.groupBy(F.col("doc_id").alias("of"), F.col("row_hash").alias("of_hash")).agg(F.collect_set("place").alias("places")))
    with released_scratch(rows.sparkSession) as keep:
        with_places = rows.join(places, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row_hash") == F.col("of_hash")))
        passages = cut_lineage(_find_passages(with_places))
        occurrence = F.struct("doc_id", "row_hash", "first")
        starts = passages.groupBy("passage").agg(F.min(occurrence).alias("kept"), F.max(occurrence).alias("other")).filter(F.col("kept") != F.col("other"))
        later = passages.join(cut_lineage(starts.select("passage", "kept")), "passage").filter(occurrence != F.col("kept"))
        same_row = F.col("doc_id").eqNullSafe(F.col("kept.doc_id")) & (F.col("row_hash") == F.col("kept.row_hash"))
        behind = F.greatest(F.col("first"), F.col("kept.first") + PASSAGE_WORDS)
        stretch = F.struct(F.when(same_row, behind).otherwise(F.col("first")).alias("first"), (F.col("first") + PASSAGE_WORDS - 1).alias("last"))
        # At most one stretch a word, so a list is bounded by its document.
        return keep(later.groupBy("doc_id", "row_hash").agg(F.collect_set(stretch).alias("stretches")))


def _with_stretches(rows: DataFrame, stretches: DataFrame) -> DataFrame:
    found = stretches.select(F.col("doc_id").alias("of"), F.col("row_hash").alias("of_hash"), "stretches")
    both = F.col("doc_id").eqNullSafe(F.col("of")) & F.col("row_hash").eqNullSafe(F.col("of_hash"))
    return rows.join(found, both, "left").drop("of", "of_hash")


def delete_repeated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """One row per input row: doc_id, text without passages seen earlier, n_lines, n_removed.

    ``n_lines`` counts lines that are not blank, ``n_removed`` those of which
    nothing is left; blank lines and all text outside deleted passages stay as
    they are, but for the blanks behind deleted words. A null text stays null.
    Documents come in the order of their ids, null first. Rows with the same id
    and text are one document and get the same result. Other columns are not
    carried.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, lines, removed = [], [], []
                for text, found in zip(part.column("text"), part.column("stretches")):
                    kept, n, gone = without(text.as_py(), found.as_py())
                    texts.append(kept)
                    lines.append(n)
                    removed.append(gone)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(lines, pa.int64()), pa.array(removed, pa.int64())],
                    ["doc_id", "row_hash", "text", "n_lines", "n_removed"],
                )

    with released_scratch(docs.sparkSession) as keep:
        with_lines = _with_stretches(rows, repeated_stretches(docs, id_col, text_col, min_words))
        left = keep(with_lines.mapInArrow(run, "doc_id bigint, row_hash bigint, text string, n_lines bigint, n_removed bigint"))
    with_words = _with_stretches(left, repeated_words(left))
    # Only texts that change go to Python, once.
    changed = F.arrow_udf(_reworded_and_emptied, "struct<text: string, emptied: bigint>")(_where_found("text", "stretches"), "stretches")
    done = with_words.withColumn("done", changed)
    gone = F.coalesce("done.emptied", F.lit(0))
    return done.select("doc_id", F.coalesce("done.text", "text").alias("text"), "n_lines", (F.col("n_removed") + gone).alias("n_removed"))


def _where_found(text: str, stretches: str) -> Column:
    return F.when(F.col(stretches).isNotNull(), F.col(text))


def _reworded_and_emptied(texts: pa.Array, stretches: pa.Array) -> pa.Array:
    done = [without_words(text.as_py(), found.as_py()) if found.is_valid else (None, None) for text, found in zip(texts, stretches)]
    return pa.StructArray.from_arrays([pa.array([t for t, _ in done], pa.string()), pa.array([n for _, n in done], pa.int64())], ["text", "emptied"])


def _reworded(texts: pa.Array, stretches: pa.Array) -> pa.Array:
    return pa.array([without_words(text.as_py(), found.as_py())[0] if found.is_valid else None for text, found in zip(texts, stretches)], pa.string())


def without_words(text: str, stretches: Sequence[dict]) -> tuple[str, int]:
    """The text without the words in ``stretches``, and how many lines went as nothing of them is left."""
    gone = {i for s in stretches for i in range(s["first"], s["last"] + 1)}
    lines, at, emptied = [], 0, 0
    for line in text.split("\n"):
        words = list(_WORD.finditer(line))
        here = [i for i in range(len(words)) if at + i in gone]
        at += len(words)
        if here and len(here) == len(words):
            emptied += 1
            continue
        for i in reversed(here):
            end = words[i + 1].start() if i + 1 < len(words) else len(line)
            line = line[: words[i].start()] + line[end:]
        lines.append(line)
    return "\n".join(lines), emptied


def apply_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents, all columns, without the words of repeated passages; a document of which nothing is left goes."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).cast("string").alias("text"))
    return _applied(docs, repeated_words(rows), _reworded, id_col, text_col, chars_col)


def apply_stretches(docs: DataFrame, stretches: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents, all columns, without those stretches; a document of which nothing is left goes.

    ``chars_col``, where there is such a column and it is not null, becomes the length of what is left.
    """
    return _applied(docs, stretches, _shortened, id_col, text_col, chars_col)


def _applied(docs: DataFrame, stretches: DataFrame, shortened_by: Callable[[pa.Array, pa.Array], pa.Array], id_col: str, text_col: str, chars_col: str) -> DataFrame:
    of, of_hash, here, left = (fresh(docs, name) for name in ("of", "of_hash", "stretches", "left"))
    found = stretches.select(F.col("doc_id").alias(of), F.col("row_hash").alias(of_hash), F.col("stretches").alias(here))
    both = docs.join(found, F.col(id_col).cast("bigint").eqNullSafe(F.col(of)) & (F.xxhash64(text_col) == F.col(of_hash)), "left")
    shortened = both.withColumn(left, F.arrow_udf(shortened_by, "string")(_where_found(text_col, here), F.col(here)))
    kept = shortened.filter(F.col(left).isNull() | (F.trim(left) != ""))
    out = kept.withColumn(text_col, F.coalesce(left, text_col))
    if chars_col in docs.columns:
        length = F.length(left).cast(docs.schema[chars_col].dataType)
        out = out.withColumn(chars_col, F.when(F.col(chars_col).isNotNull() & F.col(left).isNotNull(), length).otherwise(F.col(chars_col)))
    return out.select(*docs.columns)


def _shortened(texts: pa.Array, stretches: pa.Array) -> pa.Array:
    return pa.array([without(text.as_py(), found.as_py())[0] if found.is_valid else None for text, found in zip(texts, stretches)], pa.string())


def without(text: str | None, stretches: Sequence[dict] | None) -> tuple[str | None, int, int]:
    """The text without the lines in ``stretches``, its number of lines and how many went."""
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    numbers = [i for i, line in enumerate(lines) if line.strip()]
    gone = {numbers[i] for s in stretches or () for i in range(s["first"], s["last"] + 1)}
    return "\n".join([line for i, line in enumerate(lines) if i not in gone]) if gone else text, len(numbers), len(gone)
