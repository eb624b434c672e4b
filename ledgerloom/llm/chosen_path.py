"""Near-duplicate documents by a chosen-path set similarity join.

A document is its set of word shingles. Documents with the same set are one
class, and only classes are compared. Each of ``trees`` independent trees
branches on minwise tokens: a node picks one of 64 minwise hash functions (one
time in four, two), and its members go on to the child named by their minimum
under it. Two sets of similarity s agree on a function with probability s, so
at s = 0.8 a pair shares one child on average however deep the tree gets, while
unlike sets part quickly. A node with at most ``small`` members is compared
exhaustively; a larger one branches again.

Sets that are much alike would stay together at every level. So in each large
node ``PIVOTS`` of its members are pivots, and its members are compared with the
pivot that most members are like. Those confirmed to be linked with a pivot
follow it and, where they are ``small / 2`` or more, leave the trees, so a node
shrinks by its copies at every level and only the others branch again.

What a follower is linked with besides is found by differences from its pivot.
Let ``D(x)`` be the shingles that only one of x and the pivot has. If x is linked
with a follower y but not with the pivot, ``D(x)`` and ``D(y)`` share more than
``(percent * a + 100 * b) / (100 + percent)`` shingles, a and b being what y has
more and less than the pivot: with fewer, x and y would differ more than x and
the pivot may. So all but that many of ``D(y)`` are enough to find y by, the
rarest first. This is asked for the sets near a pivot (similarity ``reach``) that
share a large node with it and are not in its component. Members still together
in a large node after ``deepest`` levels are compared wherever their components
differ. Nothing is capped.

Comparisons are first made on 256-bit sketches (one bit of a minimum each),
whose cut lies 4 standard deviations under the threshold, and then confirmed
on full shingle sets. Each set is first confirmed against its most similar
candidate; candidates within one component then need no confirming. Sets are
built for candidates only: a Bloom filter of at most ``FILTER_BITS`` bits says
which documents to shingle again, and an exact join settles its mistakes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import only
from ledgerloom.llm.components import connected
from ledgerloom.session import cut_lineage

FUNCTIONS = 64
SKETCH_BITS = 256
TREES = 12
PIVOTS = 8
HEADS = 4
SMALL = 32
STEP = 2
DEEPEST = 10
FILTER_BITS = 1 << 27
WORDS_KEPT = 300_000
_U64 = np.uint64
_rng = np.random.default_rng(20240901)
_XOR = _rng.integers(0, 1 << 32, FUNCTIONS + SKETCH_BITS, dtype=np.uint32)
_TIMES = _rng.integers(0, 1 << 32, FUNCTIONS + SKETCH_BITS, dtype=np.uint32) | np.uint32(1)


class Likeness(NamedTuple):
    """Sets are linked when ``100 * shared >= percent * all``; a shingle is ``words`` words."""

    words: int = 5
    percent: int = 80


def mixed(x: np.ndarray) -> np.ndarray:
    """A fixed 64-bit permutation."""
    x = x.astype(_U64, copy=True)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x ^= x >> _U64(shift)
        x *= _U64(factor)
    return x ^ (x >> _U64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = _WordHashes()


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles; fewer words than a shingle has are one shingle."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return np.zeros(0, _U64)
    only(_hashes)
    if len(_hashes) > WORDS_KEPT:
        _hashes.clear()
    h = np.fromiter(map(_hashes.__getitem__, found), _U64, len(found))
    width = min(words, len(found))
    joined = np.full(len(h) - width + 1, width, _U64)
    for i in range(width):
        joined = mixed(joined * _U64(0x9E3779B97F4A7C15) + h[i : len(h) - width + 1 + i])
    return np.unique(joined)


def minima(shingles: np.ndarray, at_once: int = 2048) -> np.ndarray:
    """The minimum of the set under every hash function."""
    x = (shingles ^ (shingles >> _U64(32))).astype(np.uint32)
    least = np.full(len(_XOR), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), at_once):
        np.minimum(least, ((x[at : at + at_once, None] ^ _XOR) * _TIMES).min(axis=0), out=least)
    return least


def branch(nodes: np.ndarray, minwise: np.ndarray, levels: int) -> tuple[np.ndarray, np.ndarray]:
    """Children after some levels: (row, node), for a node and the 64 minima of each row."""
    row = np.arange(len(nodes))
    for _ in range(levels):
        choice = mixed(nodes)
        first = (choice % _U64(FUNCTIONS)).astype(np.int64)
        again = (choice >> _U64(62)) == 0  # one time in four
        second = (first + 1 + ((choice >> _U64(20)) % _U64(FUNCTIONS - 1)).astype(np.int64)) % FUNCTIONS
        place = np.concatenate((first, second[again]))
        row, nodes = np.concatenate((row, row[again])), np.concatenate((nodes, nodes[again]))
        nodes = mixed(nodes ^ mixed((place.astype(_U64) << _U64(32)) | minwise[row, place].astype(_U64)))
    return row, nodes


# --- tables ------------------------------------------------------------------------------------


def _signatures(docs: DataFrame, like: Likeness) -> DataFrame:
    """doc_id, size, class (digest of the set, null if empty), minwise and sketch of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                sizes, classes, minwise, sketches = [], [], [], []
                for text in part.column(1):
                    found = shingle_set(text.as_py(), like.words)
                    sizes.append(len(found))
                    if not len(found):
                        classes.append(None), minwise.append(None), sketches.append(None)
                        continue
                    classes.append(xxhash.xxh3_128_digest(found.tobytes()))
                    least = minima(found)
                    minwise.append(least[:FUNCTIONS].tobytes())
                    sketches.append(np.packbits((least[FUNCTIONS:] >> np.uint32(9)).astype(np.uint8) & 1).view(np.int64))
                parts = [pa.array([None if s is None else s[i] for s in sketches], pa.int64()) for i in range(4)]
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(minwise, pa.binary()), *parts]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "size", "class", "minwise", "s0", "s1", "s2", "s3"])

    return docs.mapInArrow(run, "doc_id bigint, size bigint, class binary, minwise binary, s0 bigint, s1 bigint, s2 bigint, s3 bigint")


# ``root`` names the component that is known of a class, null if there is none.
_CARRIED = ["class", "root", "size", "s0", "s1", "s2", "s3"]
_NODE_SCHEMA = "node bigint, class binary, root binary, size bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint"


def _branched(rows: DataFrame, levels: int, trees: int = 0) -> DataFrame:
    """Rows of (node,) minwise and what is carried, in the nodes some levels further down; ``trees`` starts them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roots = mixed(np.arange(1, trees + 1, dtype=_U64))
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                least = np.frombuffer(b"".join(part.column("minwise").to_pylist()), np.uint32).reshape(-1, FUNCTIONS)
                if trees:
                    start, of = np.tile(roots, len(least)), np.repeat(np.arange(len(least)), trees)
                else:
                    start, of = part.column("node").to_numpy().view(_U64), np.arange(len(least))
                row, nodes = branch(start, least[of], levels)
                kept = part.select(_CARRIED).take(pa.array(of[row]))
                yield pa.RecordBatch.from_arrays([pa.array(nodes.view(np.int64)), *kept.columns], ["node", *_CARRIED])

    columns = ([] if trees else ["node"]) + ["minwise", *_CARRIED]
    return rows.select(*columns).mapInArrow(run, _NODE_SCHEMA)


def largest_distance(percent: float, deviations: float = 4.0) -> int:
    """Sketch bits in which two sets of this similarity may differ, some standard deviations included."""
    p = (1 - percent / 100) / 2
    return math.ceil(SKETCH_BITS * p + deviations * math.sqrt(SKETCH_BITS * p * (1 - p)))


def reach(percent: float) -> float:
    """The least similarity of a leader with a set that is linked with its follower."""
    return max(0.0, 100 - 2 * (100 - percent))


def _distance(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(f"{a}.s{i}").bitwiseXOR(F.col(f"{b}.s{i}"))) for i in range(1, 4)), F.bit_count(F.col(f"{a}.s0").bitwiseXOR(F.col(f"{b}.s0"))))


def _may_be_alike(a: str, b: str, percent: float, deviations: float = 4.0) -> Column:
    sizes = F.least(f"{a}.size", f"{b}.size") * 100 >= F.greatest(f"{a}.size", f"{b}.size") * percent
    return sizes & (_distance(a, b) <= largest_distance(percent, deviations))


def _apart() -> Column:
    """Whether x and y are not known to be in one component."""
    return F.coalesce(F.col("x.root") != F.col("y.root"), F.lit(True))


def _in_order() -> list[Column]:
    """Columns of a pair (x, y): the classes in order and their distance."""
    return [F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"), _distance("x", "y").alias("distance")]


def _pairs(a: DataFrame, b: DataFrame, when: Column, percent: float, columns: list[Column]) -> DataFrame:
    """Pairs of classes in one node that may be linked, as far as sketches tell."""
    return a.alias("x").join(b.alias("y"), (F.col("x.node") == F.col("y.node")) & when & _may_be_alike("x", "y", percent)).select(*columns)


def _distinct(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("a", "b").agg(F.min("distance").alias("distance"))


def _pivot_pairs(many: DataFrame, percent: int) -> DataFrame:
    """Members of large nodes with one pivot of the node, that of the pivots they may be linked with which most members are like."""
    own = ["class", "size", "s0", "s1", "s2", "s3"]
    picks = [F.min(F.struct(F.xxhash64("class", F.lit(i)).alias("h"), *own)).alias(f"p{i}") for i in range(PIVOTS)]
    pivots = cut_lineage(many.groupBy("node").agg(*picks))
    like = [(F.col("x.class") != F.col(f"p{i}.class")) & _may_be_alike("x", f"p{i}", percent) for i in range(PIVOTS)]
    counts = many.alias("x").join(pivots, "node").groupBy("node").agg(*[F.count_if(c).alias(f"n{i}") for i, c in enumerate(like)])
    counted = cut_lineage(pivots.join(counts, "node"))
    each = [F.when(c, F.struct(F.col(f"n{i}").alias("n"), (-_distance("x", f"p{i}")).alias("near"), F.col(f"p{i}.class").alias("class"))) for i, c in enumerate(like)]
    met = many.alias("x").join(counted, "node").select(F.col("x.class").alias("member"), F.array_max(F.array(*each)).alias("p"))
    return met.filter("p IS NOT NULL").select("member", F.col("p.class").alias("pivot"), F.col("p.n").alias("n"), (-F.col("p.near")).alias("distance"))


def _leading(many: DataFrame) -> DataFrame:
    """(node, lead, outside): the component with most members of each node, and the number of those outside."""
    by_root = many.groupBy("node", F.coalesce("root", "class").alias("root")).agg(F.count(F.lit(1)).alias("n"))
    found = by_root.groupBy("node").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"))
    return found.select("node", F.col("most.root").alias("lead"), (F.col("n") - F.col("most.n")).alias("outside"))


def _tree_pairs(docs: DataFrame, classes: DataFrame, like: Likeness, trees: int, small: int, deepest: int) -> tuple[DataFrame, DataFrame | None, DataFrame | None, DataFrame | None]:
    """Pairs that may be linked, links confirmed on the way, the sets this took, and the rows of large nodes to be compared across components (None: there are none)."""
    found, links, sets, rest, depth = [], None, None, None, STEP
    minwise = classes.select(F.col("class").alias("of"), "minwise")
    rows = _branched(classes.withColumn("root", F.lit(None).cast("binary")), STEP, trees)
    while True:
        large = cut_lineage(rows.groupBy("node").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > small).select("node"))
        last = large.isEmpty()
        if not last:
            many = cut_lineage(rows.join(large, "node", "left_semi"))
            follows, between, sets = _followers(docs, classes, many, sets, like, small)
            links = _all([t for t in (links, follows, between) if t is not None])
            if not follows.isEmpty():
                pairs, sets = _by_differences(docs, classes, many, follows, connected(links), sets, like)
                if pairs is not None:
                    found.append(pairs)
            if depth == STEP:  # the first rows are not stored
                led = follows.select(F.col("a").alias("of"), F.col("b").alias("root"))
                rows = _branched(cut_lineage(classes.join(led, F.col("class") == F.col("of"), "left").drop("of")), STEP, trees)
        few = rows if last else rows.join(large, "node", "left_anti")
        found.append(cut_lineage(_distinct(_pairs(few, few, (F.col("x.class") < F.col("y.class")) & _apart(), like.percent, _in_order()))))
        if last:
            break
        many = many.join(follows.select(F.col("a").alias("class")), "class", "left_anti").select("node", *_CARRIED)
        if depth >= deepest:
            rest = cut_lineage(many)
            break
        rows = cut_lineage(_branched(many.join(minwise, F.col("class") == F.col("of")), STEP))
        depth += STEP
    return _distinct(_all(found)), links, sets, rest


def _all(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _across_components(rest: DataFrame, roots: DataFrame, percent: int) -> DataFrame:
    """All pairs in large nodes whose members are in different components: those outside a node's leading component against all."""
    root = F.coalesce("now", "class").alias("root")
    now = roots.select(F.col("node").alias("of"), F.col("root").alias("now"))
    carried = [root if c == "root" else c for c in _CARRIED]
    placed = cut_lineage(rest.join(now, F.col("class") == F.col("of"), "left").select("node", *carried))
    outside = placed.join(_leading(placed), "node").filter(F.col("root") != F.col("lead")).select("node", *_CARRIED)
    return _pairs(cut_lineage(outside), placed, _apart(), percent, _in_order()).select("a", "b")


def _filter_words(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of ``doc_id`` as 64-bit words; its length follows the count, up to ``FILTER_BITS``."""
    bits = min(FILTER_BITS, 1 << max(16, math.ceil(math.log2(16 * ids.count() + 1))))
    bit = F.explode(F.array(*[F.pmod(F.xxhash64("doc_id", F.lit(i)), F.lit(bits)) for i in range(2)]))
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).cast("int").alias("word"))
    found = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("ones")).toPandas()  # at most bits / 64 rows
    out = np.zeros(bits // 64, np.int64)
    out[found["word"].to_numpy(np.int64)] = found["ones"]
    return out


def _sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, like: Likeness) -> DataFrame:
    """(class, shingles) of the wanted classes, made again from the documents that represent them."""
    wanted = cut_lineage(classes.select("class", "doc_id").join(wanted.distinct(), "class", "left_semi"))
    shared = docs.sparkSession.sparkContext.broadcast(_filter_words(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = shared.value
        for batch in batches:
            places = np.stack([batch.column(i).to_numpy() for i in (1, 2)], axis=1) % (len(words) * 64)
            hit = np.flatnonzero(((words[places >> 6] >> (places & 63)) & 1).all(axis=1)).tolist()
            for at in range(0, len(hit), 256):
                classes, sets = [], []
                for i in hit[at : at + 256]:
                    found = shingle_set(batch.column(0)[i].as_py(), like.words)
                    if len(found):
                        classes.append(xxhash.xxh3_128_digest(found.tobytes()))
                        sets.append(found.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(classes, pa.binary()), pa.array(sets, pa.binary())], ["class", "shingles"])

    rows = docs.filter("doc_id IS NOT NULL").select("text", F.xxhash64("doc_id", F.lit(0)), F.xxhash64("doc_id", F.lit(1)))
    return cut_lineage(rows.mapInArrow(run, "class binary, shingles binary").join(wanted.select("class"), "class", "left_semi"))


def _with_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, sets: DataFrame | None, like: Likeness) -> DataFrame:
    """The sets there are and those of the wanted classes."""
    if sets is None:
        return _sets(docs, classes, wanted, like)
    return sets.unionByName(_sets(docs, classes, wanted.join(sets, "class", "left_anti"), like))


def _followers(docs: DataFrame, classes: DataFrame, many: DataFrame, sets: DataFrame | None, like: Likeness, small: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (a, b) of members of large nodes with the pivots they follow, links found by one try between components, and the sets."""
    met = cut_lineage(_pivot_pairs(many, like.percent).groupBy("member", "pivot").agg(F.max("n").alias("n"), F.min("distance").alias("distance")))
    sets = _with_sets(docs, classes, met.select(F.col("member").alias("class")).unionByName(met.select(F.col("pivot").alias("class"))), sets, like)
    common = cut_lineage(met.groupBy("member").agg(F.max_by("pivot", F.struct("n", "pivot")).alias("b")).withColumnRenamed("member", "a"))
    follows = cut_lineage(confirmed(common, sets, like.percent))
    # Those that are not linked with the pivot of most try their closest one.
    others = met.withColumnsRenamed({"member": "a", "pivot": "b"}).join(follows, "a", "left_anti").join(common, ["a", "b"], "left_anti")
    closest = cut_lineage(others.groupBy("a").agg(F.min_by("b", F.struct("distance", "b")).alias("b")))
    follows = cut_lineage(follows.unionByName(confirmed(closest, sets, like.percent)))
    roots = connected(follows)
    a, b = (roots.select(F.col("node").alias(f"of_{n}"), F.col("root").alias(f"root_{n}")) for n in "ab")
    placed = met.join(a, F.col("member") == F.col("of_a")).join(b, F.col("pivot") == F.col("of_b"))
    between = placed.filter("root_a != root_b").groupBy(F.least("root_a", "root_b").alias("low"), F.greatest("root_a", "root_b").alias("high"))
    likeliest = cut_lineage(between.agg(F.min(F.struct("distance", "member", "pivot")).alias("p")).select(F.col("p.member").alias("a"), F.col("p.pivot").alias("b")))
    between = cut_lineage(confirmed(likeliest, sets, like.percent))
    if follows.isEmpty():
        return follows, between, sets
    return *_gathered(follows, between, sets, like.percent, small // 2), sets


def _gathered(follows: DataFrame, links: DataFrame, sets: DataFrame, percent: int, fewest: int) -> tuple[DataFrame, DataFrame]:
    """Followers behind the first they are linked with of the ``HEADS`` pivots of their component that most follow, where a pivot has ``fewest``; and all links."""
    roots = connected(follows.unionByName(links)).select(F.col("node").alias("of"), "root")
    sizes = follows.groupBy("b").agg(F.count(F.lit(1)).alias("n")).join(roots, F.col("b") == F.col("of"))
    ranked = sizes.withColumn("place", F.row_number().over(Window.partitionBy("root").orderBy(F.desc("n"), "b")))
    heads = cut_lineage(ranked.filter(f"place <= {HEADS}").select("root", "place", F.col("b").alias("head")))
    theirs = follows.join(ranked.select("b", "root", "place"), "b").alias("f").join(heads.alias("h"), (F.col("f.root") == F.col("h.root")) & (F.col("f.place") > F.col("h.place")) & (F.col("f.a") != F.col("h.head")))
    tried = cut_lineage(theirs.select("a", F.col("head").alias("b")))
    better = confirmed(tried, sets, percent).join(heads.select(F.col("head").alias("b"), "place"), "b")
    moved = cut_lineage(better.groupBy("a").agg(F.min_by("b", "place").alias("to")))
    now = cut_lineage(follows.join(moved, "a", "left").select("a", "b", "to"))
    behind = now.select("a", F.coalesce("to", "b").alias("b"))
    worth = behind.groupBy("b").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= fewest).select("b")
    return cut_lineage(behind.join(worth, "b", "left_semi").select("a", "b")), links.unionByName(now.select("a", "b"))


def _by_differences(docs: DataFrame, classes: DataFrame, many: DataFrame, follows: DataFrame, roots: DataFrame, sets: DataFrame, like: Likeness) -> tuple[DataFrame | None, DataFrame]:
    """Pairs of a follower, or its pivot, with a set outside its component near the pivot; and the sets."""
    now = roots.select(F.col("node").alias("of"), F.col("root").alias("now"))
    placed = cut_lineage(many.join(now, F.col("class") == F.col("of"), "left").select("node", *[F.coalesce("now", "class").alias("root") if c == "root" else c for c in _CARRIED]))
    pivots = cut_lineage(placed.join(follows.select(F.col("b").alias("class")).distinct(), "class", "left_semi").select("node", *_CARRIED))
    pair = [F.col("x.class").alias("member"), F.col("y.class").alias("pivot")]
    outside = cut_lineage(_pairs(placed, pivots, _apart(), reach(like.percent), pair).distinct())
    if outside.isEmpty():
        return None, sets
    sets = _with_sets(docs, classes, outside.select(F.col("member").alias("class")), sets, like)
    followers = follows.select(F.col("a").alias("member"), F.col("b").alias("pivot")).join(outside.select("pivot").distinct(), "pivot", "left_semi")
    both = outside.withColumn("follower", F.lit(False)).unionByName(followers.withColumn("follower", F.lit(True)))
    apart = cut_lineage(_differences(both, sets, like.percent))
    direct = apart.filter("linked AND NOT follower").select(F.least("member", "pivot").alias("a"), F.greatest("member", "pivot").alias("b"), F.lit(0).alias("distance"))
    x = apart.filter("NOT linked AND NOT follower").select("pivot", F.col("member").alias("x"), F.col("size").alias("x_size"), F.size("shingles").alias("x_n"), F.explode("shingles").alias("shingle"))
    y = apart.filter("follower").select("pivot", F.col("member").alias("y"), F.col("size").alias("y_size"), F.size("shingles").alias("y_n"), "enough", F.explode("shingles").alias("shingle"))
    # Of both sides' differences those go first that the fewest sets outside have.
    often = x.groupBy("pivot", "shingle").agg(F.count(F.lit(1)).alias("n"))
    order = [F.coalesce("n", F.lit(0)), "shingle"]
    first = y.join(often, ["pivot", "shingle"], "left").withColumn("rank", F.row_number().over(Window.partitionBy("pivot", "y").orderBy(*order)))
    first = first.filter("rank <= enough AND n IS NOT NULL").drop("enough", "n")
    x = x.join(often, ["pivot", "shingle"]).withColumn("x_rank", F.row_number().over(Window.partitionBy("pivot", "x").orderBy(*order))).drop("n")
    # The further x is from the pivot, the more they have to share: of so many, the first has as many behind it on both sides.
    least = F.ceil(((100 + like.percent) * (F.col("x_n") + F.col("y_n")) - (100 - like.percent) * (F.col("x_size") + F.col("y_size"))) / (2 * (100 + like.percent)))
    met = (F.col("f.pivot") == F.col("o.pivot")) & (F.col("f.shingle") == F.col("o.shingle")) & (F.col("rank") + least <= F.col("y_n") + 1) & (F.col("x_rank") + least <= F.col("x_n") + 1)
    shared = first.alias("f").join(x.alias("o"), met).groupBy("x", "y").agg(F.min(F.col("x_n") + F.col("y_n")).alias("n"))
    found = shared.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.col("n").cast("int").alias("distance"))
    return cut_lineage(_distinct(direct.unionByName(found))), sets


def _differences(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (member, pivot, follower) with whether they are linked, the member's size, the shingles that one of them has, and how many of those are enough to find a follower by."""
    left, right = (sets.select(F.col("class").alias(f"class_{n}"), F.col("shingles").alias(f"set_{n}")) for n in "ab")
    both = pairs.join(left, F.col("member") == F.col("class_a")).join(right, F.col("pivot") == F.col("class_b")).select("member", "pivot", "follower", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                linked, sizes, enough, differences = [], [], [], []
                for member, pivot in zip(part.column(3), part.column(4)):
                    member, pivot = np.frombuffer(member.as_py(), _U64), np.frombuffer(pivot.as_py(), _U64)
                    apart = np.setxor1d(member, pivot, assume_unique=True)
                    more = (len(apart) + len(member) - len(pivot)) // 2
                    linked.append(len(apart) * (100 + percent) <= (len(member) + len(pivot)) * (100 - percent))
                    sizes.append(len(member))
                    enough.append(len(apart) - (percent * more + 100 * (len(apart) - more)) // (100 + percent))
                    differences.append(apart.view(np.int64))
                columns = [*part.columns[:3], pa.array(linked, pa.bool_()), pa.array(sizes, pa.int64()), pa.array(enough, pa.int64()), pa.array(differences, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["member", "pivot", "follower", "linked", "size", "enough", "shingles"])

    return both.mapInArrow(run, "member binary, pivot binary, follower boolean, linked boolean, size bigint, enough bigint, shingles array<bigint>")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) that reach the threshold on their full sets."""
    left, right = (sets.select(F.col("class").alias(f"class_{n}"), F.col("shingles").alias(f"set_{n}")) for n in "ab")
    both = pairs.join(left, F.col("a") == F.col("class_a")).join(right, F.col("b") == F.col("class_b")).select("a", "b", "set_a", "set_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_py(), _U64), np.frombuffer(y.as_py(), _U64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))

    return both.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", like: Likeness = Likeness(), trees: int = TREES, small: int = SMALL, deepest: int = DEEPEST) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept.

    Words are cut at white space after lowering A-Z. A document without words
    has no shingle and is linked with nothing. ``component_id`` is the smallest
    id reachable over links, the row's own included, and ``kept`` says that it
    is the row's own. A row with a null id is linked with nothing, has a null
    component and is kept. Rows that repeat in full are one document and get the
    same result. Other columns are not carried.
    """
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = cut_lineage(_signatures(rows, like))
    first = F.min(F.struct("doc_id", "size", "minwise", "s0", "s1", "s2", "s3")).alias("first")
    in_a_class = signed.filter(F.col("class").isNotNull() & F.col("doc_id").isNotNull())
    classes = cut_lineage(in_a_class.groupBy("class").agg(first).select("class", "first.*"))
    pairs, links, sets, rest = _tree_pairs(rows, classes, like, trees, small, deepest)
    pairs = cut_lineage(pairs)
    wanted = pairs.select(F.col("a").alias("class")).unionByName(pairs.select(F.col("b").alias("class")))
    if rest is not None:
        wanted = wanted.unionByName(rest.select("class"))
    sets = _with_sets(rows, classes, wanted, sets, like)

    closest = pairs.groupBy("b").agg(F.min_by("a", F.struct("distance", "a")).alias("a")).select("a", "b")
    links = cut_lineage(_all([confirmed(closest, sets, like.percent), *([links] if links is not None else [])]))
    roots = connected(links)
    left = _between_components(pairs.select("a", "b"), roots).join(closest, ["a", "b"], "left_anti")
    if rest is not None:
        # The closest ones first: most members outside then are in the component, and the search below has little to do.
        links, roots = _extended(links, roots, left, sets, like.percent)
        left = _across_components(rest, roots, like.percent)
    _, roots = _extended(links, roots, left.distinct(), sets, like.percent)
    return _labelled(signed.select("doc_id", "size", "class"), classes.select("class", F.col("doc_id").alias("head")), roots)


def _extended(links: DataFrame, roots: DataFrame, pairs: DataFrame, sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links and components with those of the pairs that are confirmed."""
    more = cut_lineage(confirmed(cut_lineage(pairs), sets, percent))
    if more.isEmpty():
        return links, roots
    links = links.unionByName(more)
    return links, connected(links)


def _between_components(pairs: DataFrame, roots: DataFrame) -> DataFrame:
    a, b = (roots.select(F.col("node").alias(f"of_{n}"), F.col("root").alias(f"root_{n}")) for n in "ab")
    placed = pairs.join(a, F.col("a") == F.col("of_a"), "left").join(b, F.col("b") == F.col("of_b"), "left")
    return placed.filter(F.coalesce("root_a", "a") != F.coalesce("root_b", "b")).select("a", "b")


def _labelled(members: DataFrame, heads: DataFrame, roots: DataFrame) -> DataFrame:
    placed = heads.join(roots, F.col("class") == F.col("node"), "left").withColumn("root", F.coalesce("root", "class"))
    smallest = placed.groupBy("root").agg(F.min("head").alias("component"))
    component = cut_lineage(placed.join(smallest, "root").select(F.col("class").alias("of"), "component"))
    named = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return members.join(component, F.col("class") == F.col("of"), "left").select(
        "doc_id", F.col("size").alias("n_shingles"), named.alias("component_id"), F.coalesce(named == F.col("doc_id"), F.lit(True)).alias("kept")
    )
