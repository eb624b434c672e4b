"""Ratios, calendar arithmetic and priority ranks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Report order of the priority labels; anything else ranks last.
PRIORITY_RANK = {"Critical": 1, "High": 2, "Medium": 3}
LOWEST_RANK = 4


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Division as double that yields null for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def minute_of(ts: Column) -> Column:
    """Whole minutes since the epoch, without any zone shift for zone-less timestamps."""
    return F.timestamp_diff("MINUTE", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.date_trunc("minute", ts).cast("timestamp_ntz"))


def minute_boundaries(start: Column, end: Column) -> Column:
    """Number of minute boundaries crossed, e.g. 10:00:59 to 10:16:00 is 16."""
    return minute_of(end) - minute_of(start)


def priority_rank(priority: Column) -> Column:
    rank = F.lit(LOWEST_RANK)
    for label, position in PRIORITY_RANK.items():
        rank = F.when(priority == label, F.lit(position)).otherwise(rank)
    return rank


def date_key(day: Column) -> Column:
    """Integer surrogate yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")
