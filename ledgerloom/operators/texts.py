"""Texts put together from many rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PREFIX_LENGTH = 2


def ordered_list(rows: DataFrame, group: list[str], item: str, separator: str, prefix: int = PREFIX_LENGTH) -> DataFrame:
    """The items of each group as one text in their order, in column ``item``; null items are left out.

    Equal items are counted once first. Items are then joined among those of the
    same first letters, and these parts in the order of their letters, which is
    the order of the items: the items of one hot group are gathered by many
    tasks, and only the finished parts meet. A group without items has none.
    """
    distinct = rows.filter(F.col(item).isNotNull()).groupBy(*group, item).agg(F.count("*"))
    letters = F.left(F.col(item), F.lit(prefix)).alias("_letters")
    parts = (
        distinct.select(*group, letters, item)
        .groupBy(*group, "_letters")
        .agg(F.expr(f"listagg(`{item}`, '{separator}') WITHIN GROUP (ORDER BY `{item}`)").alias("_part"))
    )
    return parts.groupBy(*group).agg(F.expr(f"listagg(_part, '{separator}') WITHIN GROUP (ORDER BY _letters)").alias(item))
