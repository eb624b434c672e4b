"""Tables the nightly jobs keep, which reports and the shop front read instead of making them again.

Each is stored once per application and state of its source files: when a source
file changes, the next reader stores a new one next to it, so no plan ever
reads a table that is being replaced.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ledgerloom.session import file_stamps, scratch_path

# What is stored where: paths and schemas only, one entry a table kept.
_kept: dict[tuple, tuple[str, T.StructType]] = {}


def kept(spark: SparkSession, name: str, sources: list[str], write: Callable[[str], T.StructType]) -> DataFrame:
    """The table ``name`` made from the files of ``sources``; ``write`` stores it at a path and returns its schema."""
    key = (spark.sparkContext.applicationId, name, *(file_stamps(spark, path) for path in sources))
    if key not in _kept:
        path = scratch_path(spark, name)
        _kept[key] = (path, write(path))
    path, schema = _kept[key]
    return spark.read.schema(schema).parquet(path)


def kept_table(spark: SparkSession, name: str, sources: list[str], write: Callable[[str, str], None]) -> DataFrame:
    """As ``kept`` for a table or view of the catalogue; ``write`` gets its name, and a path it may use."""
    key = (spark.sparkContext.applicationId, name, *(file_stamps(spark, path) for path in sources))
    if key not in _kept:
        table = f"{name}_{uuid.uuid4().hex}"
        write(table, scratch_path(spark, name))
        _kept[key] = (table, spark.table(table).schema)
    return spark.table(_kept[key][0])
