"""Comparing two copies of a table by digest trees, so that equal parts are never read.

Each copy is stored in leaves by a hash of its key, with a tree of digests next
to it: per leaf, and per node above, the number of rows, the sum and the
exclusive-or of their hashes. None of the three depends on the order of rows, so
a node's digest is the sum of its children's. Two trees are compared from the
root down: only the children of nodes that differ are looked at, and only leaves
that differ are read row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import tables

LEAF = "leaf"
MISSING = "MISSING"
STALE = "STALE"
SURPLUS = "SURPLUS"

_DIGEST = "level int, node int, rows bigint, total decimal(38,0), mixed bigint"


@dataclass(frozen=True)
class TreeShape:
    """``fan ** depth`` leaves; their number bounds what a comparison collects."""

    fan: int = 8
    depth: int = 2

    @property
    def leaves(self) -> int:
        return self.fan**self.depth


def _row_hash(columns: list[str]) -> Column:
    """A hash that tells nulls apart from their neighbours: a null alone leaves a hash as it was."""
    return F.xxhash64(*[x for name in columns for x in (F.col(name).isNull(), F.col(name))])


def _digest(rows: str = "rows", total: str = "total", mixed: str = "mixed") -> list[Column]:
    return [
        F.sum(rows).cast("bigint").alias("rows"),
        F.sum(F.col(total).cast("decimal(38,0)")).cast("decimal(38,0)").alias("total"),
        F.bit_xor(mixed).alias("mixed"),
    ]


def store(rows: DataFrame, key: str, path: str, shape: TreeShape = TreeShape()) -> None:
    """Store a copy in leaves, and its digests. Rows with a null key lie in the leaf of the hash of null."""
    spark, columns = rows.sparkSession, rows.columns
    leaf = F.pmod(F.xxhash64(key), F.lit(shape.leaves)).cast("int").alias(LEAF)
    tables.write_partitioned(rows.select("*", leaf), f"{path}/rows", [LEAF])
    stored = read_leaves(spark, path, rows.schema)
    hashed = stored.select(LEAF, F.lit(1).alias("rows"), _row_hash(columns).alias("total"), _row_hash(columns).alias("mixed"))
    leaves = hashed.groupBy(LEAF).agg(*_digest())
    # Every leaf also counts for each of its ancestors; there are few leaves.
    above = F.array(*[F.struct(F.lit(n).alias("level"), F.floor(F.col(LEAF) / shape.fan ** (shape.depth - n)).cast("int").alias("node")) for n in range(shape.depth + 1)])
    nodes = leaves.select("*", F.explode(above).alias("at")).groupBy("at.level", "at.node").agg(*_digest())
    nodes.coalesce(1).write.mode("error").parquet(f"{path}/digests")


def read_leaves(spark: SparkSession, path: str, schema: T.StructType, leaves: list[int] | None = None) -> DataFrame:
    """The stored rows; ``leaves`` names the folders to read."""
    full = T.StructType([*schema.fields, T.StructField(LEAF, T.IntegerType())])
    rows = spark.read.schema(full).parquet(f"{path}/rows")
    return rows if leaves is None else rows.filter(F.col(LEAF).isin(leaves))


def _level(spark: SparkSession, path: str, level: int, nodes: list[int]) -> DataFrame:
    return spark.read.schema(_DIGEST).parquet(f"{path}/digests").filter((F.col("level") == level) & F.col("node").isin(nodes))


def differing_leaves(spark: SparkSession, one: str, other: str, shape: TreeShape = TreeShape()) -> list[int]:
    """Leaves in which the two copies differ, found from the root down."""
    open_nodes = [0]
    for level in range(shape.depth + 1):
        a, b = (_level(spark, path, level, open_nodes).alias(name) for path, name in ((one, "a"), (other, "b")))
        same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in ("rows", "total", "mixed")]
        pairs = a.join(b, F.col("a.node") == F.col("b.node"), "full_outer").filter(~(same[0] & same[1] & same[2]))
        differ = sorted(r[0] for r in pairs.select(F.coalesce("a.node", "b.node")).collect())
        if not differ or level == shape.depth:
            return differ
        open_nodes = [n * shape.fan + i for n in differ for i in range(shape.fan)]
    return []


def reconcile(spark: SparkSession, source: str, copy: str, schema: T.StructType, key: str, shape: TreeShape = TreeShape()) -> DataFrame:
    """Keys the copy lacks (MISSING), holds in another state (STALE), or has too many (SURPLUS), from differing leaves alone.

    Keys identify rows; rows with a null key are not compared.
    """
    leaves = differing_leaves(spark, source, copy, shape)
    sides = [
        read_leaves(spark, path, schema, leaves).filter(F.col(key).isNotNull()).select(key, F.struct(*schema.names).alias(name))
        for path, name in ((source, "_wanted"), (copy, "_held"))
    ]
    verdict = (
        F.when(F.col("_held").isNull(), F.lit(MISSING)).when(F.col("_wanted").isNull(), F.lit(SURPLUS)).otherwise(F.lit(STALE))
    )
    both = sides[0].join(sides[1], key, "full_outer").filter(~F.col("_wanted").eqNullSafe(F.col("_held")))
    return both.select(key, verdict.alias("verdict"))
