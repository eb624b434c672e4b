"""How filters act on each other: what every order of applying them removes, step by step.

The relations are id tables. One pass over the texts finds who fails which
filter, and the ids of those who fail are stored, one table a filter. All else
is joins of ids:

* survivors of a prefix are the survivors of a prefix with one filter less,
  left-anti joined with the id table of that filter;
* removals of a step are the survivors before it, left-semi joined with the id
  table of its filter, and their labels are the step's label losses;
* redundant failures of a step are the rows of that id table that are not among
  these survivors.

Survivors depend on which filters a prefix holds, not on their order, so the 325
prefixes of five filters share 32 survivor relations. They are held in one
table, nested: a row carries the list of the sets that it survives. A filter's
left-anti and left-semi join then extend half of these relations at once, and
five pairs of joins give all of them.

Rows. A document row is a row of the result's counts, whatever its id: repeated
rows and ids count as often as they occur, and rows with a null id are counted
like others. Null texts count as empty. A duplicate is a row whose text another
row with a smaller id has; a null id is neither smaller nor larger than another,
so its row is no duplicate and makes none. Null sources count as the empty
string. A document is good (toxic) if any row of ``labels`` with its id says so;
label rows with a null id or value say nothing. Texts are read whole, however
long. An empty table has no parts and gives no rows. Columns of ``documents``
other than doc_id, text and source are not read, so their names cannot clash.
"""

from __future__ import annotations

from functools import reduce
from itertools import permutations
from math import factorial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import SPACES, whole_text
from ledgerloom.session import cut_lineage, scratch_path

LETTERS = "ABCDE"
LEAST_WORDS = 50
LEAST_DISTINCT = 65  # percent of the words
MOST_CAPITALS = 5  # percent of the code points
MARKS = r"[#$%&*|]"
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def _bit(letter: str) -> int:
    return 1 << LETTERS.index(letter)


def _verdicts(docs: DataFrame) -> DataFrame:
    """One row a document: a number of its own, doc_id, part, a digest of the text and what filters A to D say."""
    words = F.array_remove(F.split("_text", SPACES + "+"), "")
    read = docs.select("doc_id", F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), whole_text("text").alias("_text"))
    counted = read.select(
        "doc_id",
        "part",
        F.sha2(F.col("_text").cast("binary"), 256).alias("digest"),
        F.col("_text").rlike(MARKS).alias("D"),
        F.length("_text").alias("_points"),
        (F.length("_text") - F.length(F.regexp_replace("_text", "[A-Z]+", ""))).alias("_capitals"),
        words.alias("_words"),
    ).withColumns({"_n": F.size("_words"), "_distinct": F.size(F.array_distinct("_words"))})
    failing = {
        "A": F.col("_n") < LEAST_WORDS,
        "B": F.col("_distinct") * 100 < F.col("_n") * LEAST_DISTINCT,
        "C": F.col("_capitals") * 100 > F.col("_points") * MOST_CAPITALS,
    }
    return counted.select(F.monotonically_increasing_id().alias("row"), "doc_id", "part", "digest", *[c.alias(n) for n, c in failing.items()], "D")


def failing_ids(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, dict[str, DataFrame]]:
    """All rows (row, doc_id, part, good, toxic), and for each filter the stored table of those that fail it.

    Row numbers hold because they are read back, never generated again.
    """
    verdicts = cut_lineage(_verdicts(docs))
    said = labels.filter("doc_id is not null").groupBy("doc_id").agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    flags = [F.coalesce(name, F.lit(False)).alias(name) for name in ("good", "toxic")]
    rows = cut_lineage(verdicts.join(said, "doc_id", "left").select("row", "doc_id", "part", "digest", *"ABCD", *flags))
    found = {letter: rows.filter(letter) for letter in "ABCD"}
    firsts = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
    # A row with an id that is not the first of its text has a smaller one before it.
    found["E"] = rows.filter("doc_id is not null").join(firsts, ["digest", "doc_id"], "left_anti")
    root, columns = scratch_path(docs.sparkSession, "failing-ids"), ["row", "doc_id", "part", "good", "toxic"]
    tables = {}
    for letter, failed in found.items():
        ids = failed.select(*columns)
        ids.write.parquet(f"{root}/filter={letter}")
        tables[letter] = docs.sparkSession.read.schema(ids.schema).parquet(f"{root}/filter={letter}")
    return rows.select(*columns), tables


def _survivors(rows: DataFrame, failed: dict[str, DataFrame]) -> DataFrame:
    """Every row with ``sets``, the sets of filters it survives; a set is the sum of its letters' bits.

    A row that is not among the ids of a filter survives the sets so far with and
    without it; a row that is among them survives only those without it.
    """
    left = rows.select("row", "part", "good", "toxic", F.array(F.lit(0)).alias("sets"))
    for letter in LETTERS:
        ids, bit = failed[letter].select("row"), F.lit(_bit(letter))
        passed = left.join(ids, "row", "left_anti").withColumn("sets", F.concat("sets", F.transform("sets", lambda past: past + bit)))  # noqa: B023
        left = cut_lineage(passed.unionByName(left.join(ids, "row", "left_semi")))
    return left


def _met(left: DataFrame, failed: dict[str, DataFrame], letter: str) -> DataFrame:
    """What the ids of a filter meet after each set of others: rows still there are removed by it, the rest fail it redundantly."""
    before = F.explode(F.array(*[F.lit(past) for past in range(1 << len(LETTERS)) if not past & _bit(letter)]))
    met = left.join(failed[letter].select("row"), "row", "left_semi").select("part", "good", "toxic", "sets", before.alias("past"))
    here = F.array_contains("sets", F.col("past"))
    return met.groupBy("part", "past", F.lit(letter).alias("letter")).agg(
        F.count_if(here).alias("removed"), F.count_if(~here).alias("redundant"), F.count_if(here & F.col("good")).alias("good_lost"), F.count_if(here & F.col("toxic")).alias("toxic_lost")
    )


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row per part, order of the filters and step: see ``COUNTS``, zeros included."""
    rows, failed = failing_ids(docs, labels)
    left = _survivors(rows, failed)
    kept = left.select("part", F.explode("sets").alias("past")).groupBy("part", "past").agg(F.count("*").alias("kept"))
    met = reduce(DataFrame.union, [_met(left, failed, letter) for letter in LETTERS])
    return _report(cut_lineage(kept), cut_lineage(met))


def _report(kept: DataFrame, met: DataFrame) -> DataFrame:
    """Every part in all orders, with the counts of each step; both inputs have a few rows a part."""
    orders = F.explode(F.split(F.lit(",".join(map("".join, permutations(LETTERS)))), ",")).alias("filter_order")
    steps = F.explode(F.sequence(F.lit(1), F.lit(len(LETTERS)))).alias("step")
    among = lambda n: sum((F.contains(F.col("filter_order").substr(F.lit(1), n), F.lit(x)).cast("int") * _bit(x) for x in LETTERS), F.lit(0))
    grid = (
        kept.select("part").distinct().select("part", orders).select("part", "filter_order", steps)
        .select("*", F.col("filter_order").substr(F.col("step"), F.lit(1)).alias("letter"), among(F.col("step") - 1).alias("past"), among(F.col("step")).alias("then"))
    )
    # Of all orders, k! (4 - k)! have a given set of k filters before a given one.
    weight = F.element_at(F.array(*[F.lit(factorial(k) * factorial(len(LETTERS) - 1 - k)) for k in range(len(LETTERS))]), F.bit_count("past") + 1)
    of_filter = met.groupBy("part", "letter").agg(
        F.sum(F.when(F.bit_count("past") == len(LETTERS) - 1, F.col("removed"))).alias("unique_fails"), F.sum(F.col("removed") * weight).alias("shapley")
    )
    full = (
        grid.join(kept.withColumnRenamed("past", "then"), ["part", "then"], "left")
        .join(met, ["part", "past", "letter"], "left")
        .join(of_filter, ["part", "letter"], "left")
    )
    return full.select("part", "filter_order", "step", *[F.coalesce(F.col(c).cast("bigint"), F.lit(0).cast("bigint")).alias(c) for c in COUNTS])


SQL = r"""
WITH words AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
           list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w : w <> '') AS w
    FROM documents
), verdicts AS (
    SELECT doc_id, part,
           CASE WHEN len(w) < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 2 ELSE 0 END
           + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 5 * length(t) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS fails
    FROM words
), said AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), masks AS (
    SELECT part, fails, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
    FROM verdicts LEFT JOIN said USING (doc_id) GROUP BY part, fails
), letters AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS x (l, b)
), orders AS (
    SELECT concat(a.l, b.l, c.l, d.l, e.l) AS filter_order, [a.b, b.b, c.b, d.b, e.b] AS bits
    FROM letters a, letters b, letters c, letters d, letters e WHERE a.b + b.b + c.b + d.b + e.b = 31 AND a.b | b.b | c.b | d.b | e.b = 31
), steps AS (
    SELECT filter_order, step, bits[step] AS f, CAST(coalesce(list_sum(bits[1:step - 1]), 0) AS INTEGER) AS past
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step) s
), counted AS (
    SELECT part, filter_order, step, f,
           sum(CASE WHEN fails & (past | f) = 0 THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN fails & past = 0 AND fails & f <> 0 THEN n ELSE 0 END) AS removed,
           sum(CASE WHEN fails & past <> 0 AND fails & f <> 0 THEN n ELSE 0 END) AS redundant,
           sum(CASE WHEN fails = f THEN n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN fails & past = 0 AND fails & f <> 0 THEN good ELSE 0 END) AS good_lost,
           sum(CASE WHEN fails & past = 0 AND fails & f <> 0 THEN toxic ELSE 0 END) AS toxic_lost
    FROM masks, steps GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
       CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counted
"""
