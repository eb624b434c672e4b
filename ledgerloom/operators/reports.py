"""Issue-register reports, scoreboards and log rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.scalars import priority_rank


def issue_report(register: DataFrame, columns: Sequence[str], priority: str | None = None) -> DataFrame:
    """Issues in id order, all of them or those of one priority."""
    rows = register if priority is None else register.filter(F.col("priority") == priority)
    return rows.select(*columns).orderBy("problem_id")


def priority_summary(register: DataFrame) -> DataFrame:
    return (
        register.groupBy("priority")
        .agg(F.count("*").alias("total"))
        .orderBy(priority_rank(F.col("priority")), "priority")
    )


def area_summary(register: DataFrame) -> DataFrame:
    return (
        register.groupBy("problem_area")
        .agg(F.count("*").alias("total_issues"))
        .orderBy(F.desc("total_issues"), "problem_area")
    )


def register_with_decisions(register: DataFrame, decisions: DataFrame, decision_columns: Sequence[str]) -> DataFrame:
    """Every issue with its decision, if any, in priority and id order."""
    joined = register.join(decisions.select("problem_id", *decision_columns), "problem_id", "left")
    return joined.orderBy(priority_rank(F.col("priority")), "problem_id")


def ranked_register(register: DataFrame, columns: Sequence[str]) -> DataFrame:
    return register.select(*columns).orderBy(priority_rank(F.col("priority")), "problem_id")


def kpi_scoreboard(
    tables: Sequence[tuple[DataFrame, Mapping[str, str]]], notes: Mapping[str, str] | None = None
) -> DataFrame:
    """(item, value) text rows.

    Each table comes with its items: label to SQL condition, ``true`` for a plain
    count. All items of one table are counted in one pass. ``notes`` are constant rows.
    """
    parts = []
    for rows, items in tables:
        counts = rows.agg(*[F.count_if(F.expr(condition)).alias(label) for label, condition in items.items()])
        pairs = ", ".join(f"'{label}', cast(`{label}` as string)" for label in items)
        parts.append(counts.selectExpr(f"stack({len(items)}, {pairs}) as (item, value)"))
    if notes:
        spark = tables[0][0].sparkSession
        parts.append(literal_rows(spark, list(notes.items()), "item string, value string"))
    board = parts[0]
    for part in parts[1:]:
        board = board.unionByName(part)
    return board


def literal_rows(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A constant list, such as numbered actions, as a table."""
    return spark.createDataFrame(list(rows), schema)


def derive_log_rows(source: DataFrame, key: str, constants: Mapping[str, str]) -> DataFrame:
    """One row per source row: its key and fixed texts."""
    return source.select(key, *[F.lit(text).alias(name) for name, text in constants.items()])
