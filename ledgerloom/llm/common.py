"""Small helpers the operators share."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The white space of the contracts, space and 0x09 to 0x0D.
SPACES = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str) -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that the table does not have, whatever columns it has besides those an operator knows."""
    taken = {column.lower() for column in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


_in_use: list = []


def only(table) -> None:
    """Say that a task works with this table of its worker process.

    Workers are used again by operator after operator; the table of the one
    before is emptied when the next one starts, so tables do not add up.
    """
    if not _in_use or _in_use[0] is not table:
        for other in _in_use:
            other.clear()
        pa.default_memory_pool().release_unused()
        _in_use[:] = [table]


def squeezed(text: Column) -> Column:
    """Text without its white space."""
    return F.regexp_replace(text, SPACES + "+", "")
