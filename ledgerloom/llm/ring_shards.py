"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has ``virtual_nodes`` points on a ring. A row belongs to the first
point clockwise of its key; when that point's shard is full it goes on to the
next point of a shard that is not. Shards hold equal row counts, or one row
more, so balance is exact, and rows move only when a shard is full.

The ring is divided into ``2 ** CELL_BITS`` cells, the unit in which rows
arrive. How many rows each cell has is all that the walk along the ring needs;
this count table has a fixed number of rows, so the walk is a small loop on the
driver, whatever the size of the data. It yields, per cell, which stretch of the
cell's rows goes to which shard and from which slot on. A row then needs only
its rank in its cell.

Ranks follow the hash of id, size and checksum. Rows that agree in all three
cannot be told apart in the result; they are counted before any shuffle and
written out again after placement, so a row repeated any number of times is one
row of the sort.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.llm.common import whole_text
from ledgerloom.session import cut_lineage

CELL_BITS = 14
VIRTUAL_NODES = 128
# Copies of one row are written out again by at most so many at a time.
COPIES_AT_ONCE = 10_000

STRETCH = T.StructType(
    [
        T.StructField("cell", T.IntegerType()),
        T.StructField("from_rank", T.LongType()),
        T.StructField("to_rank", T.LongType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("slot_from", T.LongType()),
    ]
)


def place_on_ring(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", virtual_nodes: int = VIRTUAL_NODES) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard.

    ``size`` is the UTF-8 length of the text plus one; a null text has length
    none and the checksum of the empty text. Rows that repeat in full are placed
    one by one. A null id is a key like any other. An empty table gives an empty
    result. ``law`` is ``rows``: shard counts differ by one at most.
    """
    text = whole_text(text_col).cast("binary")
    rows = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    kinds = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies"))
    stored = cut_lineage(kinds.withColumn("hash", F.xxhash64("doc_id", "size", "text_crc32")).withColumn("cell", _cell(F.xxhash64("doc_id", "text_crc32"))))
    counts = {r.cell: r.rows for r in stored.groupBy("cell").agg(F.sum("copies").alias("rows")).collect()}  # one row per cell at most
    stretches = docs.sparkSession.createDataFrame(list(walk(counts, shards, virtual_nodes)), STRETCH)
    order = W.partitionBy("cell").orderBy("hash", "doc_id", "size", "text_crc32")
    ranked = stored.withColumn("rank", F.sum("copies").over(order) - F.col("copies"))
    block = ranked.withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("copies") - 1, F.lit(COPIES_AT_ONCE).cast("bigint"))))
    last = F.least(F.col("first") + COPIES_AT_ONCE, "copies") - 1
    single = block.withColumn("nth", F.explode(F.sequence("first", last))).withColumn("place", F.col("rank") + F.col("nth"))
    placed = single.join(
        F.broadcast(stretches).withColumnRenamed("cell", "at"),
        (F.col("cell") == F.col("at")) & (F.col("place") >= F.col("from_rank")) & (F.col("place") < F.col("to_rank")),
    )
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard",
        (F.col("slot_from") + F.col("place") - F.col("from_rank")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )


def _cell(hashed: Column) -> Column:
    return F.shiftrightunsigned(hashed, 64 - CELL_BITS).cast("int")


def ring_points(shards: int, virtual_nodes: int) -> list[tuple[int, int]]:
    """Sorted (position, shard) of all virtual nodes; a shard's points do not depend on the other shards."""
    return sorted((_mixed(f"shard {s} node {v}"), s) for s in range(shards) for v in range(virtual_nodes))


def _mixed(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=4).digest(), "big")


def walk(counts: dict[int, int], shards: int, virtual_nodes: int = VIRTUAL_NODES) -> Iterable[tuple[int, int, int, int, int]]:
    """Place the rows of all cells: (cell, from rank, to rank, shard, slot of the first).

    Cells arrive in an order of their own, unrelated to their place on the ring.
    """
    points = ring_points(shards, virtual_nodes)
    positions = [p for p, _ in points]
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    filled = [0] * shards
    for cell in sorted(counts, key=lambda c: (_mixed(f"arrival {c}"), c)):
        start, left, done = bisect.bisect_left(positions, cell << (32 - CELL_BITS)), counts[cell], 0
        for i in range(len(points)):
            if not left:
                break
            shard = points[(start + i) % len(points)][1]
            taken = min(left, room[shard] - filled[shard])
            if taken:
                yield cell, done, done + taken, shard, filled[shard]
                filled[shard] += taken
                done, left = done + taken, left - taken
