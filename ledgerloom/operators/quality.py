"""Constraint rules as reports, and repair of broken references."""

from __future__ import annotations

import re
from collections.abc import Mapping
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom.sources import tables

# Fixed value: key of the row that adopts children without a parent.
HOLDING_KEY = -1


def constraint_report(rows: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking each rule, all rules in one pass.

    A rule that evaluates to null passes, as a CHECK does; write NOT NULL rules
    with ``isNotNull``.
    """
    broken = [F.count_if(~rule).alias(name) for name, rule in rules.items()]
    pairs = ", ".join(f"'{name}', `{name}`" for name in rules)
    return rows.agg(*broken).selectExpr(f"stack({len(rules)}, {pairs}) as (rule, violations)")


def write_counted(rows: DataFrame, path: str, counts: Mapping[str, Column]) -> tuple[DataFrame, dict[str, int]]:
    """Store rows and take aggregates of them as they pass, without a second scan: the stored table and the figures.

    The figures stand directly before the writer, so each stored partition is
    counted once, however often its task was tried.
    """
    seen = Observation()
    stored = tables.write_new(rows.observe(seen, *[count.alias(name) for name, count in counts.items()]), path)
    return stored, seen.get


def broken(rules: Mapping[str, Column]) -> dict[str, Column]:
    """Counts of the rows that break each rule, for ``write_counted``; a rule that is null holds."""
    return {name: F.count_if(~rule) for name, rule in rules.items()}


def as_items(spark: SparkSession, figures: Mapping[str, int], names: tuple[str, str] = ("item", "value")) -> DataFrame:
    """Figures taken on the way as a table."""
    return spark.createDataFrame(list(figures.items()), f"{names[0]} string, {names[1]} bigint")


def duplicate_keys(rows: DataFrame, key: list[str], rule: str) -> DataFrame:
    """Surplus rows under a uniqueness rule; counts merge map side, so a hot key stays small."""
    counted = rows.groupBy(*key).agg(F.count("*").alias("_n"))
    surplus = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0))
    return counted.agg(surplus.alias("violations")).select(F.lit(rule).alias("rule"), "violations")


def fk_violations(children: DataFrame, parents: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose non-null key has no parent."""
    return children.filter(F.col(child_key).isNotNull()).join(
        parents.select(F.col(parent_key).alias("_parent")), F.col(child_key) == F.col("_parent"), "left_anti"
    )


def reparent_orphans(
    children: DataFrame, parents: DataFrame, child_key: str, parent_key: str, holding_key: int = HOLDING_KEY
) -> DataFrame:
    """Point children of missing parents at the holding row; null keys stay null."""
    known = parents.select(F.col(parent_key).alias("_parent")).distinct()
    orphan = F.col(child_key).isNotNull() & F.col("_parent").isNull()
    kind = children.schema[child_key].dataType
    return (
        children.join(known, F.col(child_key) == F.col("_parent"), "left")
        .withColumn(child_key, F.when(orphan, F.lit(holding_key).cast(kind)).otherwise(F.col(child_key)))
        .select(*children.columns)
    )


def _filler(field: T.StructField, key: str, key_value: int, name: str, email: str, as_of: datetime) -> Column:
    """Value of one column of the holding row, chosen by column name first, type second."""
    kind = field.dataType
    if field.name == key:
        value: object = key_value
    elif re.search("name", field.name, re.IGNORECASE):
        value = name
    elif re.search("e_?mail", field.name, re.IGNORECASE):
        value = email
    elif isinstance(kind, T.StringType):
        value = "holding"
    elif isinstance(kind, T.NumericType):
        value = 0
    elif isinstance(kind, T.BooleanType):
        value = False
    elif isinstance(kind, T.DateType):
        value = as_of.date()
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        value = as_of
    elif isinstance(kind, T.VariantType):
        return F.parse_json(F.lit("{}"))
    else:
        value = None
    return F.lit(value).cast(kind)


def ensure_default_parent(
    parents: DataFrame, key: str, *, name: str, email: str, as_of: datetime, key_value: int = HOLDING_KEY
) -> DataFrame:
    """The parent table with the holding row added, unless it is there already."""
    columns = [_filler(field, key, key_value, name, email, as_of).alias(field.name) for field in parents.schema.fields]
    found = parents.filter(F.col(key) == key_value).agg(F.count("*").alias("_found"))
    return parents.unionByName(found.filter("_found = 0").select(*columns))


def remediation_scoreboard(products: DataFrame, customers: DataFrame, vault: DataFrame, letters: DataFrame, weightless: tuple[str, ...]) -> DataFrame:
    """Figures that prove each clean-up; one aggregate per table."""
    counts, inputs = scoreboard_counts(weightless), {"products": products, "customers": customers, "vault": vault, "dead_letters": letters}
    parts = [_as_rows(inputs[name].agg(*[c.alias(item) for item, c in of.items()])) for name, of in counts.items()]
    return reduce(DataFrame.unionByName, parts)


def scoreboard_counts(weightless: tuple[str, ...]) -> dict[str, dict[str, Column]]:
    """The figures of the scoreboard, by the table they are taken from."""
    return {
        "products": {
            "invalid_product_weights": F.count_if(F.col("product_type").isin(*weightless) & F.col("weight_kg").isNotNull()),
            "populated_product_descriptions": F.count("description_json"),
        },
        "customers": {
            "pan_rows_remaining_in_customers": F.count("card_last_sixteen"),
            "customers_with_json_profiles": F.count("profile_data_json"),
        },
        "vault": {"pan_rows_in_vault": F.count("*")},
        "dead_letters": {"malformed_profiles_deadlettered": F.count("*")},
    }


def _as_rows(one_row: DataFrame) -> DataFrame:
    pairs = ", ".join(f"'{name}', `{name}`" for name in one_row.columns)
    return one_row.selectExpr(f"stack({len(one_row.columns)}, {pairs}) as (item, value)")


def consolidate_shards(shards: list[DataFrame], key: str) -> tuple[DataFrame, DataFrame]:
    """All shards as one table, and the keys that more than one row claims."""
    merged = shards[0]
    for shard in shards[1:]:
        merged = merged.unionByName(shard)
    clashes = merged.groupBy(key).agg(F.count("*").alias("copies")).filter("copies > 1")
    return merged, clashes
