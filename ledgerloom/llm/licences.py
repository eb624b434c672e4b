"""Licence statements: a trained paragraph classifier, confirmed by templates.

A paragraph is a run of lines without a blank one, as far as it lies within
``CONTEXT`` lines of a word of licensing: notices wrapped over many lines are one
paragraph, and pages of other text around them are none of it. Its features are
the word n-grams (one to three words, across line ends) that occur in the
notices below and hold a word of licensing; an n-gram of everyday words alone is
none (see LICENSING). So text without such a word has no feature, gets the
model's constant, and needs no splitting: one pattern over the text finds the
others, and nothing is lost by it.

The model is a sparse multinomial logistic regression over licence families, the
class ``unknown`` for statements of any other licence, and ``none``. It learns
from variants of the notices (words left out, foreign words around them); as
``unknown``, from notices of licences that are not among the families and from
statements with made-up names; as ``none``, from at most about ``NEGATIVES``
corpus paragraphs and from licensing words out of context. Its probabilities
are calibrated by a temperature fitted on variants it has not seen. A paragraph
that is likely to be a licence, but of no family with ``LEAST_PROBABILITY``, is
``unknown``. A predicted family is confirmed when the paragraph holds most of the
word pairs of one of that family's notices, and more of them than of any other
notice, those of the unknown licences included.

Learning and scanning are DataFrame, SQL and Spark ML operations; no Python runs
on the executors.
"""

from __future__ import annotations

import random
import re
from collections import Counter
from typing import NamedTuple

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

UNKNOWN = "unknown"
NONE = "none"
NEGATIVES = 1500
VARIANTS = 12
LEAST_PROBABILITY = 0.5
CONFIRMED_SHARE = 0.6
LONGEST_NGRAM = 3
#: Lines before and after one with a word of licensing that belong to its paragraph.
CONTEXT = 6

# Common public notices by family, and what words of licensing contain.
NOTICES = {
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
        "This project is released under the Apache License 2.0.",
    ),
    "mit": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License.",
        "Licensed under the GPL, version 2 or later.",
    ),
    "lgpl": (
        "Licensed under the GNU Lesser General Public License.",
        "This library is distributed under the terms of the GNU Lesser General Public License, version 2.1.",
    ),
    "bsd": (
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0.",
    ),
    "cc-by": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright by the author. All rights reserved. No part of this work may be reproduced without permission.",
    ),
}
# Notices of public licences that are not told apart further.
OTHERS = {
    "agpl": (
        "Licensed under the GNU Affero General Public License v3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License.",
    ),
    "epl": (
        "Licensed under the Eclipse Public License.",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0.",
    ),
    "isc": (
        "Licensed under the ISC License.",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    ),
    "zlib": (
        "Licensed under the zlib License.",
        "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely.",
    ),
    "artistic": ("This package is licensed under the Artistic License 2.0.",),
    "eupl": ("Licensed under the European Union Public Licence, version 1.2.",),
    "public-domain": ("This is free and unencumbered software released into the public domain without any license.",),
    "disclaimer": (
        "The software is provided as is, without warranty of any kind, express or implied.",
        "The software is provided as is, without warranty.",
    ),
}
LICENSING = r"licens|licenc|copyright|permission|permitted|reserved|redistribut|warrant|public domain|apache|mozilla|gnu|gpl|bsd|creative|commons|\bcc\b"
_licensing = re.compile(LICENSING)
_FILLER = ("the of and to in that was for is with as on by at from page text more about here see note last new end").split()


_STATEMENTS = ("licensed under the {} license", "distributed under the terms of the {} license version {}", "released under the {} public licence", "use is subject to the {} license agreement")


class Model(NamedTuple):
    families: list[str]  # the last two are unknown and none
    constant: list[float]
    weights: dict[str, list[float]]  # by n-gram, for those with any weight
    temperature: float


# --- n-grams, once for driver constants and once for columns -----------------------------------


def words_of(text: str) -> list[str]:
    return [w for w in re.split(r"[^a-z0-9]+", text.lower()) if w]


def ngrams_of(words: list[str]) -> set[str]:
    grams = {" ".join(words[i : i + n]) for n in range(1, LONGEST_NGRAM + 1) for i in range(len(words) - n + 1)}
    return {g for g in grams if _licensing.search(g)}


def pairs_of(words: list[str]) -> set[str]:
    return {" ".join(p) for p in zip(words, words[1:])} or set(words)


def vocabulary() -> list[str]:
    return sorted({g for notices in [*NOTICES.values(), *OTHERS.values()] for n in notices for g in ngrams_of(words_of(n))})


def _words(line: Column) -> Column:
    return F.filter(F.split(F.lower(line), r"[^a-z0-9]+"), lambda w: w != "")


def _joined(words: Column, n: int) -> Column:
    """All runs of n words, joined by blanks."""
    last = F.size(words) - n
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(words, i + 1, n), " "))


def _ngrams(words: Column) -> Column:
    grams = F.array_distinct(F.concat(*[_joined(words, n) for n in range(1, LONGEST_NGRAM + 1)]))
    return F.filter(grams, lambda g: g.rlike(LICENSING))


# --- learning ----------------------------------------------------------------------------------


def training_lines(seed: int = 5) -> list[tuple[str, str, bool]]:
    """(line, family, held out) from the notices and from made-up statements: a fixed number of variants each."""
    rng = random.Random(seed)
    lines = []
    licensing = sorted({w for notices in NOTICES.values() for n in notices for w in words_of(n) if _licensing.search(w)})
    taught = [*NOTICES.items(), *((UNKNOWN, notices) for notices in OTHERS.values())]
    used = Counter(w for _, notices in [*NOTICES.items(), *OTHERS.items()] for w in {w for n in notices for w in words_of(n)})
    # A notice without the words that only its licence uses is no longer that licence's.
    needed = lambda w: _licensing.search(w) or used[w] == 1
    for family, notices in taught:
        for notice in notices:
            words = words_of(notice)
            for v in range(VARIANTS):
                kept = words if v % 3 == 0 else [w for w in words if needed(w) or len(words) < 5 or rng.random() > 0.15]
                around = [[rng.choice(_FILLER) for _ in range(rng.randrange(0, 6))] for _ in "ab"]
                lines.append((" ".join(around[0] + kept + around[1]), family, v % 4 == 3))
    for v in range(6 * VARIANTS):
        name = " ".join("".join(rng.choice("bdfklmnprstvz") + rng.choice("aeiou") for _ in range(rng.randint(2, 4))) for _ in range(rng.randint(1, 2)))
        around = [[rng.choice(_FILLER) for _ in range(rng.randrange(0, 6))] for _ in "ab"]
        said = rng.choice(_STATEMENTS).format(name, rng.randint(1, 4)).split()
        lines.append((" ".join(around[0] + said + around[1]), UNKNOWN, v % 4 == 3))
    for v in range(20 * VARIANTS):
        words = [rng.choice(_FILLER) for _ in range(rng.randrange(4, 20))]
        for _ in range(1 + v % 3):
            words.insert(rng.randrange(len(words)), rng.choice(licensing))
        lines.append((" ".join(words), NONE, v % 4 == 3))
    return lines


def _negatives(docs: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """About ``NEGATIVES`` corpus paragraphs, one of each sampled document, that hold no whole notice."""
    share = NEGATIVES / max(docs.count(), 1)
    place = F.pmod(F.xxhash64(id_col, F.lit("line")), F.lit(1 << 30)) / float(1 << 30)
    line = F.element_at(F.split(F.col(text_col), "\n"), 1)
    notice = "|".join(r"[^a-z0-9]+".join(words_of(n)) for notices in [*NOTICES.values(), *OTHERS.values()] for n in notices)
    sampled = docs.filter((place < share) & F.col(text_col).isNotNull()).select(line.alias("line"))
    held = F.pmod(F.xxhash64("line"), F.lit(4)) == 3
    return sampled.filter(~F.lower("line").rlike(notice)).select("line", F.lit(NONE).alias("family"), held.alias("held"))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    spark = docs.sparkSession
    families = [*NOTICES, UNKNOWN, NONE]
    grams = vocabulary()
    lines = spark.createDataFrame(training_lines(), "line string, family string, held boolean").unionByName(_negatives(docs, text_col, id_col))
    label = F.array_position(F.array(*map(F.lit, families)), F.col("family")) - 1
    counter = CountVectorizerModel.from_vocabulary(grams, "grams", "features", binary=True)
    rows = cut_lineage(counter.transform(lines.select(_ngrams(_words(F.col("line"))).alias("grams"), label.cast("double").alias("label"), "held")).select("features", "label", "held"))
    fitted = LogisticRegression(family="multinomial", regParam=0.002, elasticNetParam=0.5, maxIter=40).fit(rows.filter(~F.col("held")).coalesce(1))
    temperature = _temperature(fitted.transform(rows.filter("held")))
    matrix, constant = fitted.coefficientMatrix.toArray(), fitted.interceptVector.toArray()
    weights = {g: matrix[:, i].tolist() for i, g in enumerate(grams) if matrix[:, i].any()}
    return Model(families, constant.tolist(), weights, temperature)


def _temperature(scored: DataFrame) -> float:
    """The divisor of the logits that makes held-out labels likeliest."""
    logits, own = vector_to_array("rawPrediction"), F.col("label").cast("int") + 1
    top = F.array_max(logits)
    tried = [0.25 * 1.25**i for i in range(16)]
    losses = [F.avg(F.log(_sum_of_exp(logits, top, t)) - (F.element_at(logits, own) - top) / t) for t in tried]
    found = scored.agg(*losses).first()
    return min(zip(found, tried))[1] if found[0] is not None else 1.0


def _sum_of_exp(logits: Column, top: Column, temperature: float) -> Column:
    return F.aggregate(logits, F.lit(0.0), lambda total, x: total + F.exp((x - top) / temperature))


# --- scanning ----------------------------------------------------------------------------------


def _weights_table(spark: SparkSession, model: Model) -> DataFrame:
    rows = list(model.weights.items()) or [("", [0.0] * len(model.families))]
    return spark.createDataFrame(rows, "gram string, weights array<double>")


def _notices_table(spark: SparkSession) -> DataFrame:
    rows = [
        (family, number, pair, len(pairs))
        for family, notices in [*NOTICES.items(), *OTHERS.items()]
        for number, notice in enumerate(notices)
        for pairs in [sorted(pairs_of(words_of(notice)))]
        for pair in pairs
    ]
    return spark.createDataFrame(rows, "notice_family string, notice int, pair string, pairs int")


_KEY = ["doc_id", "row_hash", "line"]


def _paragraphs(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row_hash, line (its first) and words of the paragraphs around words of licensing.

    The lines of one document are looked at in order; only documents that hold
    such a word get here at all.
    """
    licensing = f"(?i){LICENSING}"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_hash"), F.col(text_col).cast("string").alias("text"))
    found = rows.filter(F.col("text").rlike(licensing)).dropDuplicates(["doc_id", "row_hash"])
    lines = found.select("doc_id", "row_hash", F.posexplode(F.split("text", "\n")).alias("at", "said"))
    document = Window.partitionBy("doc_id", "row_hash").orderBy("at")
    blank = F.trim(F.regexp_replace("said", r"[\t\r\x0B\x0C]", " ")) == ""
    run = F.count_if(blank).over(document.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    marked = lines.select("doc_id", "row_hash", "at", "said", blank.alias("blank"), run.alias("run"), F.col("said").rlike(licensing).alias("licensing"))
    within = Window.partitionBy("doc_id", "row_hash", "run").orderBy("at")
    near = marked.withColumn("near", F.max("licensing").over(within.rowsBetween(-CONTEXT, CONTEXT))).filter(F.col("near") & ~F.col("blank"))
    starts = F.coalesce(F.col("at") - F.lag("at").over(within) > 1, F.lit(True))
    number = F.count_if(F.col("starts")).over(within.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    numbered = near.withColumn("starts", starts).withColumn("part", number)
    whole = numbered.groupBy("doc_id", "row_hash", "run", "part").agg(F.min("at").alias("line"), F.array_sort(F.collect_list(F.struct("at", "said"))).alias("lines"))
    return whole.select(*_KEY, _words(F.array_join(F.col("lines.said"), " ")).alias("words"))


def licence_paragraphs(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs predicted to be a licence: doc_id, row_hash, line, family, probability, template_share, confirmed.

    ``family`` is ``unknown`` for a licence of no family, with the probability
    that it is a licence, and the share of the closest notice of another licence.
    """
    spark = docs.sparkSession
    words = cut_lineage(_paragraphs(docs, id_col, text_col))
    grams = words.select(*_KEY, F.explode(_ngrams(F.col("words"))).alias("gram"))
    sums = [F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(len(model.families))]
    summed = grams.join(F.broadcast(_weights_table(spark, model)), "gram").groupBy(*_KEY).agg(*sums)
    logits = F.array(*[(F.col(f"w{i}") + c) / model.temperature for i, c in enumerate(model.constant)])
    top = F.array_max("logits")
    total = _sum_of_exp(F.col("logits"), F.col("top"), 1.0)
    scored = summed.withColumn("logits", logits).withColumn("top", top).withColumn("all", F.transform("logits", lambda x: F.exp(x - F.col("top")) / total))
    scored = scored.withColumn("best", F.array_max(F.slice("all", 1, len(NOTICES)))).withColumn("licence", 1 - F.col("all")[len(model.families) - 1])
    named = F.element_at(F.array(*map(F.lit, model.families)), F.array_position("all", F.col("best")).cast("int"))
    family = F.when(F.col("best") >= LEAST_PROBABILITY, named).when(F.col("licence") >= LEAST_PROBABILITY, F.lit(UNKNOWN))
    probability = F.when(F.col("best") >= LEAST_PROBABILITY, F.col("best")).otherwise(F.col("licence"))
    predicted = scored.select(*_KEY, family.alias("family"), probability.alias("probability")).filter("family IS NOT NULL")
    pairs = words.select(*_KEY, F.explode(F.array_distinct(F.concat(_joined(F.col("words"), 1), _joined(F.col("words"), 2)))).alias("pair"))
    shares = (
        pairs.join(F.broadcast(_notices_table(spark)), "pair")
        .groupBy(*_KEY, "notice_family", "notice")
        .agg((F.count(F.lit(1)) / F.first("pairs")).alias("share"))
        .groupBy(*[F.col(c).alias(f"of_{c}") for c in _KEY])
        .agg(F.collect_list(F.struct("notice_family", "share")).alias("shares"))  # as many as there are notices
    )
    same = [predicted[c].eqNullSafe(shares[f"of_{c}"]) for c in _KEY]
    both = predicted.join(shares, same[0] & same[1] & same[2], "left").withColumn("shares", F.coalesce("shares", F.array().cast(shares.schema["shares"].dataType)))
    others = F.array(*map(F.lit, OTHERS))
    own = lambda x: F.when(F.col("family") == UNKNOWN, F.array_contains(others, x["notice_family"])).otherwise(x["notice_family"] == F.col("family"))
    most = lambda kind: F.coalesce(F.array_max(F.transform(F.filter("shares", kind), lambda x: x["share"])), F.lit(0.0))
    held = both.select(*_KEY, "family", "probability", most(own).alias("template_share"), most(lambda x: ~own(x)).alias("rival"))
    confirmed = (F.col("family") != UNKNOWN) & (F.col("template_share") >= CONFIRMED_SHARE) & (F.col("template_share") > F.col("rival"))
    return held.select(*_KEY, "family", "probability", "template_share", confirmed.alias("confirmed"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: Model | None = None) -> DataFrame:
    """One row per input row: doc_id, family, probability, template_share, confirmed, n_paragraphs.

    The row shows the document's best licence paragraph: confirmed ones first,
    then those of a known family, then the more probable, then the earlier.
    Documents without one, null and empty texts have family ``none``, probability
    and share 0 and no paragraph. Texts are read whole, however long. Rows with
    the same id and text get the same result; a null id is an id. An empty table
    gives no rows. Other columns are neither read nor carried.
    """
    model = model or learn(docs, id_col, text_col)
    found = licence_paragraphs(docs, model, id_col, text_col)
    order = F.struct("confirmed", F.col("family") != UNKNOWN, "probability", -F.col("line"))
    best = found.groupBy("doc_id", "row_hash").agg(F.max_by(F.struct("family", "probability", "template_share", "confirmed"), order).alias("best"), F.count(F.lit(1)).alias("n"))
    best = best.select(F.col("doc_id").alias("of"), F.col("row_hash").alias("of_hash"), "best", "n")
    rows = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("row_hash"))
    return rows.join(best, F.col("doc_id").eqNullSafe(F.col("of")) & (F.col("row_hash") == F.col("of_hash")), "left").select(
        "doc_id",
        F.coalesce("best.family", F.lit(NONE)).alias("family"),
        F.coalesce("best.probability", F.lit(0.0)).alias("probability"),
        F.coalesce("best.template_share", F.lit(0.0)).alias("template_share"),
        F.coalesce("best.confirmed", F.lit(False)).alias("confirmed"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("n_paragraphs"),
    )
