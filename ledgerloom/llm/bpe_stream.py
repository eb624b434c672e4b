"""BPE encoding as a transducer with bounded lookahead, and incremental decoding.

What follows a text can change its tokens only so far back. Merges act in the
order of the list; a difference on the right moves left when merge (u, v) takes
place in only one of two continuations, and then by the length of u. The next
merge to move it comes later in the list and its v begins with u, since that is
where the difference now starts. The longest chain of such steps, weighed by the
lengths of u, is therefore a sufficient lookahead. It is computed once from the
merge list. Tokens that end this far before the newest symbol are final and are
emitted; the rest is encoded again with what comes next, so that a word of any
length needs a fixed buffer.

The argument needs a list in which every merge makes a token of its own from
parts that are symbols or made earlier. ``Bpe`` checks this.

White space never gets into a token, so texts are cut at it and workers keep the
ids of a bounded number of words.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, normalizers, pre_tokenizers

from ledgerloom.llm.common import only

WORDS_KEPT = 250_000
# Longer words are streamed and not kept.
LONGEST_KEPT = 100
IDS_AT_ONCE = 1 << 18
ID_TYPE = np.dtype("<u4")


class Spec(NamedTuple):
    """What a tokenizers file says, as plain values."""

    ids: dict[str, int]
    merges: list[tuple[str, str]]
    suffix: str
    pattern: str
    special: list[str]
    byte_decoder: bool
    #: Code points that the library holds to be of another class than ``regex`` does, with a stand-in of its class.
    stand_ins: dict[int, str] = {}
    #: Code points that the library lowers otherwise than Python, with what it makes of them.
    lowered: dict[int, str] = {}


def read_spec(path: str) -> Spec:
    """A tokenizers file of the kind that drops white space: NFC, lower case, a splitting pattern, byte symbols."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)
    split, byte_level = found["pre_tokenizer"]["pretokenizers"]
    kinds = [n["type"] for n in found["normalizer"]["normalizers"]]
    if kinds != ["NFC", "Replace", "Lowercase"] or split["behavior"] != "Removed" or not split["invert"] or byte_level["use_regex"]:
        raise ValueError(f"{path} is not of the supported kind")
    model, decoder = found["model"], found["decoder"]
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
    special = {a["content"]: a["id"] for a in found["added_tokens"]}
    return Spec(model["vocab"] | special, merges, model["end_of_word_suffix"] or "", split["pattern"]["Regex"], list(special), bool(decoder), stand_ins(), lowered())


# Classes the splitting pattern names, each with a character of it that no alternative of the pattern names.
CLASSES = {r"\p{L}": "x", r"\p{N}": "7", r"\p{White_Space}": " "}
OTHER = "!"


# Planes with assigned characters, or kept for letters; in all others every table says "other" (tested).
PLANES = ((0, 0xD800), (0xE000, 0x40000), (0xE0000, 0xE1000))


@lru_cache(maxsize=2)
def stand_ins(planes: tuple[tuple[int, int], ...] = PLANES) -> dict[int, str]:
    """Code points of which the library's tables say something else than those of ``regex``, mostly unassigned ones.

    Both are asked once on the driver, about all code points in one text.
    """
    points = np.concatenate([np.arange(*plane) for plane in planes])
    text = "".join(map(chr, points))
    theirs, ours = np.full(len(points), OTHER), np.full(len(points), OTHER)
    for kind, character in CLASSES.items():
        inside = np.ones(len(points), bool)
        named = r"\s" if "Space" in kind else kind
        for _, (start, end) in pre_tokenizers.Split(Regex(f"[{named}]+"), "removed").pre_tokenize_str(text):
            inside[start:end] = False
        theirs[inside] = character
        for match in regex.finditer(f"[{kind}]+", text):
            ours[match.start() : match.end()] = character
    differ = theirs != ours
    return dict(zip(points[differ].tolist(), theirs[differ].tolist()))


@lru_cache(maxsize=2)
def lowered(planes: tuple[tuple[int, int], ...] = PLANES) -> dict[int, str]:
    """Code points whose lower case in the library's tables is not that of Python's, again asked all at once."""
    lines = [chr(p) for plane in planes for p in range(*plane) if p != 0x0A]
    theirs = normalizers.Lowercase().normalize_str("\n".join(lines)).split("\n")
    return {ord(c): made for c, made in zip(lines, theirs) if made != _lower(c)}


def _lower(text: str) -> str:
    """Letters are lowered one by one: no final sigma."""
    return text.replace("Σ", "σ").lower()


def _character_set(points: Iterable[int]) -> str:
    """A set for a pattern that holds these code points, as ranges."""
    ranges: list[list[int]] = []
    for point in sorted(points):
        if ranges and ranges[-1][1] == point - 1:
            ranges[-1][1] = point
        else:
            ranges.append([point, point])
    return "[" + "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in ranges) + "]"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str) -> int:
    """How many symbols before the end of the input its tokens may still change."""
    width = lambda token: len(token.removesuffix(suffix) if suffix else token)
    # reach[s]: the farthest a difference moves by later merges once it starts at a token that begins with s.
    reach: dict[str, int] = {}
    farthest = 0
    for u, v in reversed(merges):
        moved = width(u) + reach.get(u, 0)
        farthest = max(farthest, moved)
        for n in range(1, len(v) + 1):
            if reach.get(v[:n], 0) < moved:
                reach[v[:n]] = moved
    return farthest


class Bpe:
    def __init__(self, spec: Spec):
        self.spec = spec
        self.rank = {pair: n for n, pair in enumerate(spec.merges)}
        self.suffix = spec.suffix
        self._check()
        self.lookahead = sufficient_lookahead(spec.merges, spec.suffix)
        self.byte_symbol = byte_symbols()
        self.split = regex.compile(spec.pattern.replace(r"[^\s", r"[^\p{White_Space}"))
        self.special = regex.compile("|".join(map(regex.escape, spec.special))) if spec.special else None
        self.odd_case = re.compile(_character_set(spec.lowered)) if spec.lowered else None
        self.odd = re.compile(_character_set(spec.stand_ins)) if spec.stand_ins else None
        self.strings = {n: s for s, n in spec.ids.items()}
        self.utf8 = [self.strings.get(n, "").encode() for n in range(max(self.strings) + 1)]
        # Merges as arrays: the pair as one number, sorted, with its rank and what it makes.
        ids = spec.ids
        pair = np.array([(ids[u] << 32) | ids[v] for u, v in spec.merges], np.int64)
        order = np.argsort(pair)
        self.pairs, self.pair_rank = pair[order], order.astype(np.int64)
        self.pair_makes = np.array([ids[u + v] for u, v in spec.merges], np.int64)[order]
        self.first_ids = np.array([ids[c] for c in self.byte_symbol], np.int64)
        self.last_ids = np.array([ids[c + spec.suffix] for c in self.byte_symbol], np.int64)
        self.words: dict[str, bytes] = {}
        self.tokens: dict[str, bytes] = {}

    def _check(self) -> None:
        made: set[str] = set()
        products = {u + v for u, v in self.spec.merges}
        for u, v in self.spec.merges:
            if u + v in made or (u in products and u not in made) or (v in products and v not in made):
                raise ValueError(f"merge of {u!r} and {v!r}: a sufficient lookahead is not known for this list")
            made.add(u + v)

    def merge(self, symbols: list[str]) -> list[str]:
        """All merges on a short list of symbols, in the order of the list of merges."""
        rank = self.rank
        while len(symbols) > 1:
            best = min(zip(symbols, symbols[1:]), key=lambda pair: rank.get(pair, 1 << 60))
            if best not in rank:
                break
            u, v = best
            merged, i, last = [], 0, len(symbols) - 1
            while i <= last:
                if i < last and symbols[i] == u and symbols[i + 1] == v:
                    merged.append(u + v)
                    i += 2
                else:
                    merged.append(symbols[i])
                    i += 1
            symbols = merged
        return symbols

    def transduce(self, symbols: Iterable[str]) -> Iterator[str]:
        """Tokens of one word's symbols, each as soon as it is final."""
        held: list[str] = []
        most = 2 * self.lookahead + 64
        for symbol in symbols:
            held.append(symbol)
            if len(held) >= most:
                end, final = 0, len(held) - self.lookahead
                for token in self.merge(held):
                    width = len(token.removesuffix(self.suffix)) if self.suffix else len(token)
                    if end + width > final:
                        break
                    yield token
                    end += width
                held = held[end:]
        yield from self.merge(held)

    def _symbols(self, piece: str) -> Iterator[str]:
        data = piece.encode("utf-8", "surrogatepass")
        for i, byte in enumerate(data):
            yield self.byte_symbol[byte] + (self.suffix if i == len(data) - 1 else "")

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Place of each pair in ``pairs`` by rank, or ``_NONE``."""
        pair = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[at] == pair, (self.pair_rank[at] << 20) | at, _NONE)

    def merge_many(self, pieces: list[str]) -> list[bytes]:
        """Ids of many short pieces. Each round makes the next merge of every piece: lowest rank, then leftmost."""
        data = [p.encode("utf-8", "surrogatepass") for p in pieces]
        width = np.fromiter(map(len, data), np.int64, len(data))
        ends = np.cumsum(width)
        symbols = np.frombuffer(b"".join(data), np.uint8)
        token = self.first_ids[symbols]
        token[ends - 1] = self.last_ids[symbols[ends - 1]]
        owner = np.repeat(np.arange(len(data)), width)
        rank = np.full(len(token), _NONE)  # of a symbol with the next one
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self._rank(token[inner], token[inner + 1])
        finished: list[tuple[np.ndarray, np.ndarray]] = []
        while len(token):
            begin = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
            size = np.diff(np.append(begin, len(token)))
            lowest = np.minimum.reduceat(rank, begin)
            going = lowest != _NONE
            if not going.all():
                stays = np.repeat(going, size)
                finished.append((owner[~stays], token[~stays]))
                token, owner, rank = token[stays], owner[stays], rank[stays]
                if not len(token):
                    break
                lowest, size = lowest[going], size[going]
                begin = np.cumsum(size) - size
            found = np.flatnonzero(rank == np.repeat(lowest, size))
            left = found[np.searchsorted(found, begin)]
            token[left] = self.pair_makes[rank[left] & 0xFFFFF]
            keep = np.ones(len(token), bool)
            keep[left + 1] = False
            at = left - np.arange(len(left))  # where they are after the right halves have gone
            token, owner, rank = token[keep], owner[keep], rank[keep]
            self._renew(token, owner, rank, at)
            self._renew(token, owner, rank, at[at > 0] - 1)
        owner = np.concatenate([o for o, _ in finished])
        token = np.concatenate([t for _, t in finished]).astype(ID_TYPE)
        order = np.argsort(owner, kind="stable")
        packed = token[order].tobytes()
        stops = (4 * np.cumsum(np.bincount(owner, minlength=len(data)))).tolist()
        return [packed[a:b] for a, b in zip([0, *stops], stops)]

    def _renew(self, token: np.ndarray, owner: np.ndarray, rank: np.ndarray, at: np.ndarray) -> None:
        rank[at] = _NONE
        at = at[at + 1 < len(token)]
        at = at[owner[at] == owner[at + 1]]
        rank[at] = self._rank(token[at], token[at + 1])

    def _stream(self, piece: str) -> bytes:
        ids = self.spec.ids
        return np.fromiter((ids[t] for t in self.transduce(self._symbols(piece))), ID_TYPE).tobytes()

    def _learn(self, words: Iterable[str]) -> dict[str, bytes]:
        """Ids of words not known yet. Short ones are kept; the long ones are returned."""
        for token in self.spec.special:
            self.words[token] = ID_TYPE.type(self.spec.ids[token]).tobytes()
        pieces = {w: self._pieces(w) for w in words if w not in self.words}
        fresh = list({p for found in pieces.values() for p in found if p not in self.tokens and len(p) <= LONGEST_KEPT})
        if fresh:
            if len(self.tokens) > WORDS_KEPT:
                self.tokens.clear()
                fresh = list({p for found in pieces.values() for p in found if len(p) <= LONGEST_KEPT})
            self.tokens.update(zip(fresh, self.merge_many(fresh)))
        long = {}
        for word, found in pieces.items():
            packed = b"".join([self.tokens[p] if len(p) <= LONGEST_KEPT else self._stream(p) for p in found])
            (self.words if len(word) <= LONGEST_KEPT else long)[word] = packed
        return long

    def _pieces(self, word: str) -> list[str]:
        if self.odd is not None and not word.isascii() and self.odd.search(word):
            # A stand-in takes one place as well, so the places of the pieces are those of the word.
            return [word[m.start() : m.end()] for m in self.split.finditer(word.translate(self.spec.stand_ins))]
        return [word] if word.isalpha() else self.split.findall(word)

    def encode_many(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit numbers."""
        cut = [self._words_of(t) for t in texts]
        needed = set().union(*cut) if cut else set()
        missing = needed - self.words.keys()
        if missing and len(self.words) > WORDS_KEPT:
            self.words.clear()
            missing = needed
        known = self.words
        if missing:
            long = self._learn(missing)
            if long:
                return [b"".join([known[w] if w in known else long[w] for w in words]) for words in cut]
        return [b"".join(map(known.__getitem__, words)) for words in cut]

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    def _words_of(self, text: str) -> list[str]:
        """Words of a text; special tokens are words of their own."""
        if self.special is None or not self.special.search(text):
            return self._split_words(text)
        out, at = [], 0
        for match in self.special.finditer(text):
            out.extend(self._split_words(text[at : match.start()]))
            out.append(match[0])
            at = match.end()
        return out + self._split_words(text[at:])

    def _split_words(self, text: str) -> list[str]:
        if not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        if self.odd_case is not None and not text.isascii() and self.odd_case.search(text):
            text = text.translate(self.spec.lowered)
        text = _lower(text)
        if _ODD_SPACE.search(text):
            return [w for w in _SPACE.split(text) if w]
        return text.split()

    def decode(self, ids: bytes) -> Iterator[bytes]:
        """UTF-8 text of the ids, part by part, as the library's decode() gives it whole."""
        machine = ByteMachine(self) if self.spec.byte_decoder else PieceMachine(self)
        for at in range(0, len(ids), 4 * IDS_AT_ONCE):
            yield machine.feed(np.frombuffer(ids[at : at + 4 * IDS_AT_ONCE], ID_TYPE).tolist())
        yield machine.end()


_NONE = np.int64(1 << 62)

# str.split() also cuts at these four, which are no white space to the tokenizer.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")
_SPACE = regex.compile(r"\p{White_Space}+")


class PieceMachine:
    """For files without a decoder: tokens joined by blanks."""

    def __init__(self, bpe: Bpe):
        self.strings, self.before = bpe.utf8, b""

    def feed(self, ids: list[int]) -> bytes:
        if not ids:
            return b""
        text = self.before + b" ".join(map(self.strings.__getitem__, ids))
        self.before = b" "
        return text

    def end(self) -> bytes:
        return b""


class ByteMachine:
    """Bytes to text: holds back the bytes of a character until it is whole; broken ones become U+FFFD.

    Word ends become blanks.
    """

    def __init__(self, bpe: Bpe):
        import codecs

        self.strings, self.suffix = bpe.strings, bpe.suffix
        self.byte = {s: bytes([b]) for b, s in enumerate(bpe.byte_symbol)}
        self.special = set(bpe.spec.special)
        self.decoder = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int]) -> bytes:
        return "".join(self.decoder.decode(self._bytes(self.strings[i])) for i in ids).encode()

    def _bytes(self, token: str) -> bytes:
        if token in self.special:
            return token.encode()
        stem = token.removesuffix(self.suffix) if self.suffix else token
        return b"".join(self.byte[c] for c in stem) + (b" " if stem != token else b"")

    def end(self) -> bytes:
        return self.decoder.decode(b"", True).encode()


_last: list[tuple[str, Bpe]] = []


def _bpe(spec: Spec) -> Bpe:
    """A worker process keeps its merge table and words from task to task."""
    key = hashlib.sha256(repr((spec.merges, spec.pattern, spec.special)).encode()).hexdigest()
    only(_last)
    if not _last or _last[0][0] != key:
        _last[:] = [(key, Bpe(spec))]
    return _last[0][1]


def encode_table(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256 and, on request, the ids.

    Null counts as the empty text, which has no token. Rows are independent, so
    repeated rows and null ids pass through; other columns are not carried.
    """
    shared = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer_path))  # as long as the tokenizer file

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(shared.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                yield packed(bpe, batch.slice(at, 256))

    def packed(bpe: Bpe, batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, ids_digest, text_digest, kept = [], [], [], []
        for ids in bpe.encode_many([t.as_py() or "" for t in batch.column(1)]):
            decoded = hashlib.sha256()
            for part in bpe.decode(ids):
                decoded.update(part)
            counts.append(len(ids) // 4)
            ids_digest.append(hashlib.sha256(ids).hexdigest())
            text_digest.append(decoded.hexdigest())
            if with_ids:
                kept.append(np.frombuffer(ids, ID_TYPE).astype(np.int32))
        columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_digest), pa.array(text_digest)]
        names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        if with_ids:
            columns.append(pa.array(kept, pa.list_(pa.int32())))
            names.append("ids")
        return pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(run, schema)
