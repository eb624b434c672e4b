"""Small documents with the awkward cases every operator has to take."""

import random

from pyspark.sql import types as T

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names operators use inside.
        T.StructField("digest", T.StringType()),
        T.StructField("class", T.IntegerType()),
        T.StructField("kept", T.StringType()),
    ]
)


def documents(spark, rows):
    """A table from (doc_id, text) or (doc_id, text, lang)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else None, "s", None if r[1] is None else len(r[1]), "x", 1, "?") for r in rows]
    return spark.createDataFrame(full, DOCS)


def prose(rng, n, letters="abcdefghij"):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randint(2, 7))) for _ in range(n))


def awkward():
    rng = random.Random(9)
    long = prose(rng, 30_000)
    return [
        (1, None), (2, ""), (3, " \t\r\n\x0b\x0c "), (4, "same text here"), (5, "same  text\there"), (5, "same  text\there"), (None, "same text here"),
        (None, None), (6, "..."), (7, long), (8, long), (9, "x" * 50_000), (10, "é日本 ß😀 text"), (11, "one"), (12, "\0 nul \x1c here"),
    ]
