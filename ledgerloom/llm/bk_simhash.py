"""SimHash near-duplicates, searched with BK-trees.

Of every text the fingerprint has a bit set where over half of the hashes of its
three-word shingles have it. Rows with the same fingerprint are one entry of the
search, so copies cost nothing further, and only distinct fingerprints are
searched for others at ``RADIUS`` or fewer differing bits.

A BK-tree keys the children of a node by their Hamming distance to it. A search
takes the distance d of the wanted fingerprint to a node and follows only the
edges from d - radius to d + radius; by the triangle inequality nothing else
can lie within the radius.

The trees are shard trees of bounded size. Fingerprints that differ in at most
two bits agree in one of three blocks of the bits, so each is sent to the shards
of its three blocks, and a shard's tree answers for the fingerprints sent there:
tree and queries of a shard meet in one task, many shards at a time. (A
broadcast of all shard trees would bring every fingerprint through the driver
and grow with the corpus; that is the one point in which this differs from the
plain form of the method.) Where more than ``LARGEST`` fingerprints agree in a
block, the bits left are cut into three blocks again, of which one must agree by
the same argument, until no group is larger or no bits are left to cut. So hot
groups are split exactly, without comparing all members with all.

A task links what its tree found by a spanning forest, a link a fingerprint at
most, and connected components over these links are taken by joins.

Rows. The result has one row per row of the table. White space is space and 0x09
to 0x0D, only A to Z are lower-cased, texts are read whole in steps of bounded
memory, however long. Null and empty texts have fingerprint zero and are linked
like others. Repeated rows and ids are rows of their own with the same
component. Rows with a null id are linked and may connect others, but a null is
never the smallest id; a component of null ids alone has a null component_id. An
empty table gives no rows. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.components import connected
from ledgerloom.session import cut_lineage

WORDS = 3
SEED = 42
RADIUS = 2
BLOCKS = RADIUS + 1
BITS = 64
#: Fingerprints that may share a block before its other bits are cut up, and those a shard is meant to hold.
LARGEST = 1024
#: Hashes, and queries, that are held at once.
HASHES_AT_ONCE = 16_384
QUERIES_AT_ONCE = 256

_U64 = np.uint64


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(WORDS, len(words))
    total, ones = len(words) - width + 1, np.zeros(BITS, np.int64)
    for at in range(0, total, HASHES_AT_ONCE):
        n = min(HASHES_AT_ONCE, total - at)
        shingles = map(b" ".join, zip(*(words[at + i : at + i + n] for i in range(width))))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), _U64, n)
        ones += np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > total, bitorder="little").tobytes(), "little")


class BkTree:
    """A BK-tree over distinct codes, built a level at a time; node numbers are places in ``codes``."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes.astype(_U64)
        members, under = np.arange(1, len(codes)), np.zeros(max(len(codes) - 1, 0), np.int64)
        edges, children = [], []
        while len(members):
            distance = np.bitwise_count(self.codes[members] ^ self.codes[under])
            # The first member at a distance is the child there, all later ones go under it.
            edge, first, which = np.unique(under * (BITS + 1) + distance, return_index=True, return_inverse=True)
            edges.append(edge)
            children.append(members[first])
            later = np.ones(len(members), bool)
            later[first] = False
            under, members = members[first][which[later]], members[later]
        self.edges = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        order = np.argsort(self.edges)
        self.edges, self.children = self.edges[order], np.concatenate(children)[order] if children else np.zeros(0, np.int64)

    def search(self, wanted: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, node) places of all codes within the radius."""
        queries, found = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for at in range(0, len(wanted) if len(self.codes) else 0, QUERIES_AT_ONCE):
            query = np.arange(at, min(at + QUERIES_AT_ONCE, len(wanted)))
            node = np.zeros(len(query), np.int64)
            while len(query):
                distance = np.bitwise_count(wanted[query] ^ self.codes[node]).astype(np.int64)
                near = distance <= radius
                queries.append(query[near])
                found.append(node[near])
                base = node * (BITS + 1)
                low = np.searchsorted(self.edges, base + np.maximum(distance - radius, 0))
                high = np.searchsorted(self.edges, base + np.minimum(distance + radius, BITS), "right")
                counts = high - low
                query = np.repeat(query, counts)
                steps = np.arange(len(query)) - np.repeat(np.cumsum(counts) - counts, counts)
                node = self.children[np.repeat(low, counts) + steps]
        return np.concatenate(queries), np.concatenate(found)


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n places the smallest place it is connected with."""
    label = np.arange(n)
    while True:
        was = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == was).all():
            return label


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and code, the fingerprint as a signed number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.fromiter((fingerprint(text.as_py()) for text in batch.column(1)), _U64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes.view(np.int64))], ["doc_id", "code"])

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(run, "doc_id bigint, code bigint")


def cut(mask: int, width: int = BITS) -> list[int]:
    """A mask of bits that agree, with a third more of the other bits each."""
    free = [bit for bit in range(width) if not mask >> bit & 1]
    return [mask | sum(1 << bit for bit in free[i * len(free) // BLOCKS : (i + 1) * len(free) // BLOCKS]) for i in range(BLOCKS)]


def _signed(mask: int) -> int:
    return mask - (1 << BITS) if mask >> (BITS - 1) else mask


def _blocks(codes: DataFrame, masks: list[int]) -> DataFrame:
    """(mask, block, code): each code under the bits that each of its new masks keeps; ``codes`` names the masks it comes from."""
    new = F.create_map(*[x for m in masks for x in (F.lit(_signed(m)), F.array(*[F.lit(_signed(c)) for c in cut(m)]))])
    return codes.select(F.explode(new[F.col("mask")]).alias("mask"), "code").select("mask", F.col("mask").bitwiseAND(F.col("code")).alias("block"), "code")


def shard_entries(codes: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(mask, block, code) such that codes within the radius share a (mask, block), none of which has over ``largest`` codes while bits are left to cut."""
    open_codes, masks, done = codes.select(F.lit(0).cast("bigint").alias("mask"), "code"), [0], None
    while True:
        entries = _blocks(open_codes, masks)
        # Different cuts may lead to the same bits.
        entries = cut_lineage(entries if done is None else entries.distinct())
        masks = sorted({c for m in masks for c in cut(m)})
        hot = entries.groupBy("mask", "block").agg(F.count("*").alias("codes")).filter(F.col("codes") > largest).select("mask", "block")
        hot = cut_lineage(hot)
        masks = [m for m in masks if m.bit_count() < BITS - BLOCKS]
        if not masks or hot.isEmpty():
            return entries if done is None else done.unionByName(entries)
        cool = entries.join(hot, ["mask", "block"], "left_anti")
        done = cool if done is None else done.unionByName(cool)
        open_codes = entries.join(hot, ["mask", "block"], "left_semi").select("mask", "code").distinct()


def tree_links(codes: DataFrame, largest: int = LARGEST) -> DataFrame:
    """(a, b) links between distinct codes that connect all those within the radius of each other."""
    entries = cut_lineage(shard_entries(codes, largest))
    shards = max(1, entries.count() // largest)
    spread = entries.select(F.pmod(F.xxhash64("mask", "block"), F.lit(shards)).alias("shard"), "code").distinct()

    def run(shard: pa.Table) -> pa.Table:
        members = np.unique(shard.column("code").to_numpy())
        tree = BkTree(members.view(_U64))
        root = forest(len(members), *tree.search(tree.codes, RADIUS))
        linked = root != np.arange(len(members))
        return pa.table({"a": members[linked], "b": members[root[linked]]})

    return spread.groupBy("shard").applyInArrow(run, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, largest: int = LARGEST) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id (smallest id reachable) of every row."""
    signed = cut_lineage(fingerprints(docs))
    entries = cut_lineage(signed.groupBy("code").agg(F.min("doc_id").alias("least")))
    roots = connected(cut_lineage(tree_links(entries.select("code"), largest)))
    named = entries.join(roots, F.col("code") == F.col("node"), "left").select("code", "least", F.coalesce("root", "code").alias("root"))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"))
    homes = cut_lineage(named.select("code", "root").join(smallest, "root").select("code", "component_id"))
    return signed.join(homes, "code").select("doc_id", F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"), "component_id")
