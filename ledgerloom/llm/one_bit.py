"""Hard negatives by rotated one-bit codes.

Every vector is turned by one fixed random rotation and stored as the signs of
its components, one bit each, with its alignment a (its inner product with the
unit vector s that the signs stand for) and the length r of what is left:
v = a s + rest, the rest at right angles to s. A query q is rotated too, and its
components are quantised to four bits, so that s.q comes from popcounts of the
code with four bit planes, up to the known length e of the quantisation error.
Then

    v.q = a s.q + rest.q,   |rest.q| <= r sqrt(|q|^2 - (s.q)^2)

by Cauchy and Schwarz, which holds for every vector, with no probability in it.
Pairs whose interval cannot meet what is wanted are left out; all others are
scored exactly on whole numbers. What is wanted narrows as exact scores come in:
the fifth best so far is the least that a further row must reach.

Anchors are the stated query set. They are taken in blocks of at most
``ANCHORS_AT_ONCE`` against all codes; a block is all that is collected and
broadcast at a time, and is released when its pass is stored. Each task keeps
the first five per anchor, and then per anchor and positive, whatever the number
of rows it reads; a window merges them.

Rows. Rows with a null id, label or vector, or a null or non-finite component,
take no part. Components become floor(256 x). Vectors may differ in length: a
shorter one counts as ended by zeros. Rows with the same id are one row, that
with the smallest label and then vector, so repeated rows change nothing. Equal
scores are ranked by the smaller id. Scores beyond 64 bits are given as the
largest or smallest number of 64 bits. An anchor without another row of its
label, and a positive without a fitting negative, gives no rows, as does an
empty table. Other columns than the three named are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F

from ledgerloom.operators.folds import number_densely
from ledgerloom.session import cut_lineage, scratch_path

FIRST = 5
#: A negative has at least so many percent of its positive's score, and at most all of it.
LEAST_PERCENT = 80
SCALE = 256
ANCHOR_EVERY = 100
ANCHORS_AT_ONCE = 2048
ROWS_AT_ONCE = 1024
PAIRS_AT_ONCE = 1 << 16
PLANES = 4
SEED = 1729
LONG = np.iinfo(np.int64)

_U64 = np.uint64


@lru_cache(maxsize=1)
def rotation(dimensions: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dimensions, dimensions)))
    return q * np.sign(np.diag(r))


def _words(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    padded = np.zeros((*bits.shape[:-1], -(-bits.shape[-1] // 64) * 64), np.uint8)
    padded[..., : bits.shape[-1]] = bits
    return np.packbits(padded, axis=-1, bitorder="little").view("<u8")


class Codes(NamedTuple):
    """Vectors as one-bit codes with what bounds their inner products, and the whole numbers they come from."""

    ids: np.ndarray
    labels: np.ndarray
    units: np.ndarray
    words: np.ndarray
    align: np.ndarray
    rest: np.ndarray

    def part(self, rows: slice) -> Codes:
        return Codes(*(x[rows] for x in self))


def encode(units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, alignment, length of the rest) of rows of whole numbers."""
    turned = units.astype(float) @ rotation(units.shape[1]).T
    align = np.abs(turned).sum(axis=1) / np.sqrt(units.shape[1])
    rest = np.sqrt(np.maximum((turned * turned).sum(axis=1) - align * align, 0))
    return _words(turned >= 0), align, rest


class Anchors(NamedTuple):
    """A block of queries: bit planes of the quantised components, and what turns popcounts into bounds."""

    ids: np.ndarray
    labels: np.ndarray
    units: np.ndarray
    planes: np.ndarray
    low: np.ndarray
    step: np.ndarray
    total: np.ndarray
    error: np.ndarray
    length: np.ndarray


def prepare(ids: np.ndarray, labels: np.ndarray, units: np.ndarray) -> Anchors:
    turned = units.astype(float) @ rotation(units.shape[1]).T
    low = turned.min(axis=1)
    step = (turned.max(axis=1) - low) / ((1 << PLANES) - 1)
    levels = np.rint((turned - low[:, None]) / np.where(step > 0, step, 1)[:, None]).astype(np.int64)
    error = np.linalg.norm(turned - (low[:, None] + step[:, None] * levels), axis=1)
    planes = np.stack([_words((levels >> j & 1).astype(np.uint8)) for j in range(PLANES)], axis=1)
    return Anchors(ids, labels, units, planes, low, step, levels.sum(axis=1), error, np.linalg.norm(turned, axis=1))


def intervals(codes: Codes, anchors: Anchors) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(estimate, least, most) of every inner product, codes by anchors."""
    dimensions = codes.units.shape[1]
    shared = np.zeros((len(codes.ids), len(anchors.ids)), np.int64)
    for j in range(PLANES):
        for w in range(codes.words.shape[1]):
            shared += np.bitwise_count(codes.words[:, None, w] & anchors.planes[None, :, j, w]).astype(np.int64) << j
    ones = np.bitwise_count(codes.words).sum(axis=1, dtype=np.int64)
    along = (anchors.low * (2 * ones[:, None] - dimensions) + anchors.step * (2 * shared - anchors.total)) / np.sqrt(dimensions)
    sure = np.maximum(np.abs(along) - anchors.error, 0)
    across = np.sqrt(np.maximum(anchors.length**2 - sure**2, 0))
    width = codes.align[:, None] * anchors.error + codes.rest[:, None] * across
    # Room for the rounding of floating-point sums, far above it.
    width += 1e-9 * dimensions * np.hypot(codes.align, codes.rest)[:, None] * anchors.length + 1e-6
    middle = codes.align[:, None] * along
    return middle, middle - width, middle + width


def _exact(codes: Codes, anchors: Anchors, row: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Whole-number inner products of pairs of places."""
    most = max(max(int(u.max(initial=0)), -int(u.min(initial=0))) for u in (codes.units, anchors.units))
    kind = np.int64 if most * most * codes.units.shape[1] < LONG.max else object
    scores = [np.zeros(0, np.int64)]
    for at in range(0, len(row), PAIRS_AT_ONCE):
        here = slice(at, at + PAIRS_AT_ONCE)
        products = (codes.units[row[here]].astype(kind) * anchors.units[anchor[here]].astype(kind)).sum(axis=1)
        scores.append(products if kind is np.int64 else np.array([min(max(int(p), LONG.min), LONG.max) for p in products], np.int64))
    return np.concatenate(scores)


class _Leaders:
    """The first five (score, id) of each of a number of lists."""

    def __init__(self, lists: int):
        self.list, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self.fifth = np.full(lists, -np.inf)

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        of, score, ids = np.concatenate((self.list, of)), np.concatenate((self.score, score)), np.concatenate((self.id, ids))
        order = np.lexsort((ids, ~score, of))  # ~score falls as the score rises, and cannot overflow
        of, score, ids = of[order], score[order], ids[order]
        same = np.zeros(len(of), bool)
        same[1:] = (of[1:] == of[:-1]) & (ids[1:] == ids[:-1])
        of, score, ids = of[~same], score[~same], ids[~same]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        kept = place < FIRST
        self.list, self.score, self.id, place = of[kept], score[kept], ids[kept], place[kept]
        full = place == FIRST - 1
        self.fifth[self.list[full]] = self.score[full]


def _positives(codes: Codes, anchors: Anchors, leaders: _Leaders) -> None:
    fitting = (codes.labels[:, None] == anchors.labels) & (codes.ids[:, None] != anchors.ids)
    if not fitting.any():
        return
    middle, _, most = intervals(codes, anchors)
    # The likeliest rows first: their exact scores shut out most others.
    likely = np.argsort(np.where(fitting, -middle, np.inf), axis=0)[:FIRST]
    anchor = np.broadcast_to(np.arange(len(anchors.ids)), likely.shape)
    taken = fitting[likely, anchor]
    _score(codes, anchors, likely[taken], anchor[taken], leaders)
    fitting[likely[taken], anchor[taken]] = False
    _score(codes, anchors, *np.nonzero(fitting & (most >= leaders.fifth)), leaders)


def _score(codes: Codes, anchors: Anchors, row: np.ndarray, anchor: np.ndarray, leaders: _Leaders) -> None:
    leaders.add(anchor, _exact(codes, anchors, row, anchor), codes.ids[row])


def _least(positive: np.ndarray) -> np.ndarray:
    """The least whole score that is ``LEAST_PERCENT`` of a positive one."""
    hundreds, rest = np.divmod(positive, 100)
    return hundreds * LEAST_PERCENT - (-rest * LEAST_PERCENT // 100)


def _negatives(codes: Codes, anchors: Anchors, slots: np.ndarray, positive: np.ndarray, leaders: _Leaders) -> None:
    """``slots``: for each anchor the places of its positives in ``positive`` (their scores), -1 where it has fewer."""
    used = slots >= 0
    wanted = np.maximum(_least(positive).astype(float), leaders.fifth)
    least = np.where(used, wanted[slots], np.inf).min(axis=1)
    highest = np.where(used, positive[slots], LONG.min).max(axis=1)
    fitting = codes.labels[:, None] != anchors.labels
    _, low, most = intervals(codes, anchors)
    row, anchor = np.nonzero(fitting & (most >= least) & (low <= highest))
    score = _exact(codes, anchors, row, anchor)
    for place in range(slots.shape[1]):
        slot = slots[anchor, place]
        bound = positive[slot]
        inside = (slot >= 0) & (score <= bound) & (score >= _least(bound))
        leaders.add(slot[inside], score[inside], codes.ids[row[inside]])


# --- tables ------------------------------------------------------------------------------------


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, label and units (floor of 256 times each component) of the rows that take part, one an id."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("bigint")
    units = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("bigint"))
    rows = vectors.select("vec_id", "label", "embedding").filter("vec_id is not null and label is not null and embedding is not null").filter(sound)
    single = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.struct(label.alias("label"), units.alias("units")).alias("v")).groupBy("vec_id")
    return single.agg(F.min("v").alias("v")).select("vec_id", "v.label", "v.units")


def _matrix(column: pa.Array, dimensions: int) -> np.ndarray:
    """Lists of whole numbers as rows of one width; shorter ones end in zeros."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    values, made = column.flatten().to_numpy(), np.zeros((len(column), dimensions), np.int64)
    made[np.arange(dimensions) < lengths[:, None]] = values
    return made


def code_table(rows: DataFrame, dimensions: int) -> DataFrame:
    """``rows`` with the words of their codes, alignment and length of the rest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words, align, rest = encode(_matrix(batch.column("units"), dimensions))
            batch = batch.append_column("words", pa.array([w.tobytes() for w in words], pa.binary()))
            yield batch.append_column("align", pa.array(align)).append_column("rest", pa.array(rest))

    return rows.mapInArrow(run, "vec_id bigint, label bigint, units array<bigint>, words binary, align double, rest double")


def _codes(batch: pa.RecordBatch, dimensions: int) -> Iterator[Codes]:
    for at in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(at, ROWS_AT_ONCE)
        words = np.frombuffer(b"".join(part.column("words").to_pylist()), "<u8").reshape(part.num_rows, -1)
        plain = [part.column(name).to_numpy() for name in ("vec_id", "label", "align", "rest")]
        yield Codes(plain[0], plain[1], _matrix(part.column("units"), dimensions), words, *plain[2:])


def _searched(table: DataFrame, dimensions: int, block: object, lists: Callable[[object], int], look: Callable[[Codes, object, _Leaders], None]) -> DataFrame:
    """(list, id, score): what each task finds to be the first of every list; ``block`` is a broadcast."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = block.value
        leaders = _Leaders(lists(wanted))
        for batch in batches:
            for codes in _codes(batch, dimensions):
                look(codes, wanted, leaders)
        yield pa.RecordBatch.from_arrays([pa.array(leaders.list), pa.array(leaders.id), pa.array(leaders.score)], ["list", "id", "score"])

    found = table.mapInArrow(run, "list bigint, id bigint, score bigint")
    place = Window.partitionBy("list").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(place)).filter(F.col("rank") <= FIRST)


def _look_for_positives(codes: Codes, wanted: Anchors, leaders: _Leaders) -> None:
    _positives(codes, wanted, leaders)


def _look_for_negatives(codes: Codes, wanted: tuple, leaders: _Leaders) -> None:
    _negatives(codes, *wanted, leaders)


def _block(table: DataFrame, dimensions: int, rows: list[Row], path: str) -> None:
    """Mine for one block of anchors and store (anchor_id, positive_id, rank, negative_id and both scores)."""
    context = table.sparkSession.sparkContext
    units = np.zeros((len(rows), dimensions), np.int64)
    for place, row in enumerate(rows):
        units[place, : len(row.units)] = row.units
    anchors = prepare(np.array([r.vec_id for r in rows], np.int64), np.array([r.label for r in rows], np.int64), units)
    shared = context.broadcast(anchors)
    # At most five rows an anchor.
    found = _searched(table, dimensions, shared, lambda a: len(a.ids), _look_for_positives).collect()
    shared.destroy()
    found = sorted(found, key=lambda r: (r.list, r.rank))
    slots = np.full((len(rows), FIRST), -1, np.int64)
    for place, row in enumerate(found):
        slots[row.list, row.rank - 1] = place
    positive = np.array([r.score for r in found] or [0], np.int64)
    shared = context.broadcast((anchors, slots, positive))
    mined = _searched(table, dimensions, shared, lambda w: len(w[2]), _look_for_negatives)
    pairs = [(place, rows[r.list].vec_id, r.id, r.score) for place, r in enumerate(found)]
    named = table.sparkSession.createDataFrame(pairs, "list bigint, anchor_id bigint, positive_id bigint, positive_score bigint")
    columns = ["anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")]
    mined.join(named, "list").select(*columns).write.parquet(path)
    shared.destroy()


def hard_negatives(vectors: DataFrame, anchors_at_once: int = ANCHORS_AT_ONCE) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score; see the module."""
    spark = vectors.sparkSession
    rows = cut_lineage(usable(vectors))
    dimensions = max(1, rows.agg(F.max(F.size("units")).alias("n")).first().n or 0)
    table = cut_lineage(code_table(rows, dimensions))
    anchors = cut_lineage(number_densely(rows.filter(F.col("vec_id") % ANCHOR_EVERY == 0), ["vec_id"], "number"))
    path, count = scratch_path(spark, "hard-negatives"), anchors.count()
    for number, start in enumerate(range(0, count, anchors_at_once)):
        block = anchors.filter((F.col("number") >= start) & (F.col("number") < start + anchors_at_once)).collect()
        _block(table, dimensions, block, f"{path}/block={number}")
    schema = "anchor_id bigint, positive_id bigint, rank int, negative_id bigint, positive_score bigint, negative_score bigint"
    return spark.read.schema(schema).parquet(path).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score") if count else spark.createDataFrame([], schema)


SQL = """
WITH rows AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x : CAST(floor(CAST(x AS DOUBLE) * 256) AS DOUBLE)) AS units
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, r.vec_id AS id, a.label = r.label AS same, CAST(list_dot_product(a.units, r.units) AS BIGINT) AS score
    FROM rows a, rows r WHERE a.vec_id % 100 = 0 AND r.vec_id <> a.vec_id
), positives AS (
    SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id)
QUALIFY row_number() OVER w <= 5
"""
