"""What JSON documents hold: every path with its types, from one scan.

The documents are parsed once and taken apart a level at a time by a lateral
``variant_explode``. The members of each level are stored, and the next level
reads only the objects and arrays among them, so there is one scan of the table
however deep the documents are, and no bound on their depth.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import json_values as J
from ledgerloom.operators.json_clean import SAMPLE_LENGTH
from ledgerloom.session import cut_lineage

ROOT = "$"
ANY_ITEM = "[*]"
_PLAIN_KEY = r"^[A-Za-z0-9_]+$"


def _described(nodes: DataFrame) -> DataFrame:
    text = F.coalesce(F.try_variant_get("value", "$", "string"), F.lit("null"))
    return nodes.select("path", "value", J.type_name(F.col("value")).alias("json_type"), F.left(text, F.lit(SAMPLE_LENGTH)).alias("sample_value"))


def _members(nodes: DataFrame) -> DataFrame:
    """The members of objects and the items of arrays, with their paths; items of one array share a path."""
    spark = nodes.sparkSession
    key = F.when(F.col("key").rlike(_PLAIN_KEY), F.concat(F.lit("."), "key")).otherwise(F.concat(F.lit('."'), "key", F.lit('"')))
    step = F.when(F.col("key").isNull(), F.lit(ANY_ITEM)).otherwise(key)
    inner = nodes.select(F.col("path").alias("_above"), F.col("value").alias("_whole")).lateralJoin(spark.tvf.variant_explode(F.col("_whole").outer()))
    return inner.select(F.concat("_above", step).alias("path"), "value")


def json_nodes(rows: DataFrame, doc: str) -> list[DataFrame]:
    """The nodes (path, value, json_type, sample_value) of all documents, one stored table a level. Absent documents have none."""
    found, nodes = [], rows.filter(F.col(doc).isNotNull()).select(F.lit(ROOT).alias("path"), F.col(doc).alias("value"))
    while True:
        found.append(cut_lineage(_described(nodes)))
        nested = found[-1].filter(F.col("json_type").isin("object", "array"))
        if nested.isEmpty():
            return found
        nodes = _members(nested)


def json_paths(rows: DataFrame, doc: str) -> DataFrame:
    """Every path and JSON type with its occurrences and least sample, and the type that holds all values of the path.

    ``merged_schema`` is VARIANT where values of a path have no type in common.
    """
    nodes = json_nodes(rows, doc)
    typed = [n.groupBy("path", "json_type").agg(F.count("*").alias("occurrences"), F.min("sample_value").alias("sample_value")) for n in nodes]
    merged = [n.groupBy("path").agg(F.schema_of_variant_agg("value").alias("merged_schema")) for n in nodes]
    # A path is always as deep as its level, so levels have no path in common.
    pairs = [one.join(all_of, "path") for one, all_of in zip(typed, merged)]
    return reduce(DataFrame.unionByName, pairs).select("path", "json_type", "sample_value", "occurrences", "merged_schema")
