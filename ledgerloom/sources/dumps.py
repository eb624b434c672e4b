r"""Data dumps of a relational store, in the tab-separated text of its bulk copy.

A dump frames the rows of a table with a header that names the columns and a
closing line ``\.``; null is ``\N``, and tabs, line ends and backslashes inside
values are escaped. A line of a table with two columns or more always has a tab,
and no line of the frame has one, so lines can be told apart wherever a file is
split: reading and writing are column expressions over lines, in any number of
tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The marks of the format.
NULL_MARK = r"\N"
END_MARK = r"\."
ESCAPES = {"\b": r"\b", "\t": r"\t", "\n": r"\n", "\v": r"\v", "\f": r"\f", "\r": r"\r"}

HEADER = r"^COPY [^\t]+ \(([^\t]*)\) FROM stdin;$"
#: Other lines a dump may hold around its rows: blank ones, comments, settings, and the terminal's own commands.
FRAME = r"^(|--.*|SET .*;|SELECT pg_catalog\..*;|\\(\.|restrict.*|unrestrict.*|connect.*))$"

REASON_FIELDS = "number_of_fields"
REASON_TYPE = "type_of_"

# Stands for an escaped backslash while the other escapes are read; no text of the store can hold it.
_HELD = "\0"


def _escaped(value: Column) -> Column:
    text = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    for plain, mark in ESCAPES.items():
        text = F.replace(text, F.lit(plain), F.lit(mark))
    return F.coalesce(text, F.lit(NULL_MARK))


def _as_text(name: str, kind: T.DataType) -> Column:
    if isinstance(kind, T.BooleanType):
        return F.when(F.col(f"`{name}`"), F.lit("t")).when(~F.col(f"`{name}`"), F.lit("f"))
    return F.col(f"`{name}`").cast("string")


def write_dump(rows: DataFrame, path: str, table: str) -> None:
    """Write rows as dump files, each complete in itself. A table has two columns or more."""
    if len(rows.columns) < 2:
        raise ValueError("a dump needs two columns or more")
    line = F.concat_ws("\t", *[_escaped(_as_text(f.name, f.dataType)) for f in rows.schema.fields])
    header = f"COPY {table} ({', '.join(rows.columns)}) FROM stdin;"

    def framed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lines = lambda column: pa.RecordBatch.from_arrays([column], ["value"])
        yield lines(pa.array(["--", "-- Data of one table", "--", "", header]))
        yield from (lines(batch.column(0)) for batch in batches)
        yield lines(pa.array([END_MARK, ""]))

    rows.select(line.alias("value")).mapInArrow(framed, "value string").write.mode("error").text(path, lineSep="\n")


def _unescaped(field: Column) -> Column:
    text = F.replace(field, F.lit("\\\\"), F.lit(_HELD))
    for plain, mark in ESCAPES.items():
        text = F.replace(text, F.lit(mark), F.lit(plain))
    # Any other escaped character stands for itself.
    text = F.replace(F.regexp_replace(text, r"\\(.)", "$1"), F.lit(_HELD), F.lit("\\"))
    return F.when(field != NULL_MARK, text)


def _layout(lines: DataFrame) -> list[str]:
    """Columns as the header names them. A dump without one layout, or cut off before its end, is an error."""
    seen = lines.filter(F.col("value").rlike(HEADER) | (F.col("value") == END_MARK)).agg(
        F.collect_set(F.when(F.col("value") != END_MARK, F.regexp_extract("value", HEADER, 1))).alias("layouts"),
        F.count_if(F.col("value") == END_MARK).alias("ends"),
        F.count_if(F.col("value") != END_MARK).alias("starts"),
    ).first()
    if len(seen.layouts) != 1:
        raise ValueError(f"the dump has {len(seen.layouts)} layouts")
    if seen.starts != seen.ends:
        raise ValueError(f"the dump starts {seen.starts} times and ends {seen.ends} times")
    return [name.strip().strip('"') for name in seen.layouts[0].split(",")]


def _typed(name: str, kind: T.DataType) -> Column:
    text = F.col(f"`{name}`")
    if isinstance(kind, T.BooleanType):
        return F.when(text == "t", F.lit(True)).when(text == "f", F.lit(False))
    return text.try_cast(kind)


def read_dump(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """Rows of a dump in the columns of ``schema``, and the lines that are none, each with the reason.

    Columns are found by the names in the header, whatever their order.
    """
    lines = spark.read.text(path, lineSep="\n")
    layout = _layout(lines)
    absent = [name for name in schema.names if name not in layout]
    if absent:
        raise ValueError(f"the dump has no column {', '.join(absent)}")
    body = lines.filter(~F.col("value").rlike(HEADER) & ~F.col("value").rlike(FRAME)).select("value", F.split("value", "\t", -1).alias("_fields"))
    complete = F.size("_fields") == len(layout)
    fields = body.filter(complete).select("value", *[_unescaped(F.col("_fields")[layout.index(name)]).alias(name) for name in schema.names])
    read = fields.select("value", *[F.struct(_typed(f.name, f.dataType).alias("v"), F.col(f"`{f.name}`").isNotNull().alias("given")).alias(f.name) for f in schema.fields])
    wrong = F.coalesce(*[F.when(F.col(f"`{n}`.given") & F.col(f"`{n}`.v").isNull(), F.lit(REASON_TYPE + n)) for n in schema.names])
    judged = read.withColumn("_reason", wrong)
    rows = judged.filter("_reason IS NULL").select(*[F.col(f"`{n}`.v").alias(n) for n in schema.names])
    short = body.filter(~complete).select(F.col("value").alias("malformed_payload"), F.lit(REASON_FIELDS).alias("failure_reason"))
    mistyped = judged.filter("_reason IS NOT NULL").select(F.col("value").alias("malformed_payload"), F.col("_reason").alias("failure_reason"))
    return rows, short.unionByName(mistyped)


