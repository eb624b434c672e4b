import random

import numpy as np
import pytest
from pyspark.sql import types as T

from ledgerloom.llm import one_bit as m

VECTORS = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("embedding", T.ArrayType(T.FloatType())),
        T.StructField("label", T.IntegerType()),
        # Names operators use inside.
        T.StructField("units", T.StringType()),
        T.StructField("rank", T.IntegerType()),
    ]
)


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], VECTORS)


def plain(rows):
    """By the contract, all pairs scored."""
    used = {}
    for vec, x, label in rows:
        if vec is None or label is None or x is None or any(c is None or not np.isfinite(c) for c in x):
            continue
        units = [int(np.floor(float(np.float32(c)) * 256)) for c in x]
        made = ((label + 1) % 10 if vec % 7 == 0 else label, units)
        used[vec] = min(used.get(vec, made), made)
    out = []
    for anchor in (v for v in used if v % 100 == 0):
        label, q = used[anchor]
        score = {v: sum(a * b for a, b in zip(q, u)) for v, (_, u) in used.items()}
        ranked = sorted(used, key=lambda v: (-score[v], v))
        for positive in [v for v in ranked if v != anchor and used[v][0] == label][:5]:
            p = score[positive]
            fitting = [v for v in ranked if used[v][0] != label and 80 * p <= 100 * score[v] <= 100 * p]
            out += [(anchor, positive, i, v, p, score[v]) for i, v in enumerate(fitting[:5], 1)]
    return sorted(out)


def clustered(rng, n, dimensions=24, step=10):
    centres = [[rng.gauss(0, 1) for _ in range(dimensions)] for _ in range(6)]
    return [(i * step, [c + rng.gauss(0, 0.6) for c in rng.choice(centres)], rng.randrange(4)) for i in range(n)]


def test_against_all_pairs(spark):
    rng = random.Random(5)
    rows = clustered(rng, 400)
    rows += [(100_000 + i, rows[3][1], i % 3) for i in range(60)]  # many copies: ties
    rows += [(1, None, 1), (2, [0.5] * 24, None), (3, [None] + [0.1] * 23, 1), (4, [float("nan")] * 24, 1), (5, [float("inf")] * 24, 2), (None, [0.1] * 24, 1)]
    rows += [(200_000, [0.0] * 24, 1), (200_100, [], 1), (200_200, [1.0, 2.0], 2), rows[7], (rows[8][0], rows[9][1], 3)]
    got = sorted(tuple(r)[:6] for r in m.hard_negatives(table(spark, rows).repartition(5)).collect())
    assert got == plain(rows) and len(got) > 200
    # Blocks of anchors change nothing.
    assert sorted(tuple(r)[:6] for r in m.hard_negatives(table(spark, rows), anchors_at_once=7).collect()) == got


def test_huge_components_do_not_overflow(spark):
    rows = [(100, [1e9, 0.0], 1), (1, [1e9, 1.0], 1), (2, [9.9e8, 1e3], 2), (300, [3e30, 1.0], 1)]
    got = {(r.anchor_id, r.positive_id, r.negative_id): r.negative_score for r in m.hard_negatives(table(spark, rows)).collect()}
    assert all(score <= 2**63 - 1 for score in got.values())


def test_nothing_to_find(spark):
    assert m.hard_negatives(table(spark, [])).collect() == []
    assert m.hard_negatives(table(spark, [(1, [0.1], 1), (2, [0.1], 1)])).collect() == []
    assert m.hard_negatives(table(spark, [(100, [0.1], 1), (2, [0.1], 2)])).collect() == []


def test_intervals_hold_for_every_pair():
    rng = np.random.default_rng(3)
    for dimensions in (1, 3, 64, 100):
        units = np.rint(rng.standard_normal((300, dimensions)) * 60).astype(np.int64)
        units[::10] = units[0]
        units[5] = 0
        words, align, rest = m.encode(units)
        ids = np.arange(300)
        codes, anchors = m.Codes(ids, ids, units, words, align, rest), m.prepare(ids[:40], ids[:40], units[:40])
        middle, low, high = m.intervals(codes, anchors)
        exact = units @ units[:40].T
        assert (low <= exact).all() and (exact <= high).all()
        if dimensions == 64:
            # The intervals say something: the estimate follows the score, the width stays under the trivial one.
            assert np.corrcoef(middle.ravel(), exact.ravel())[0, 1] > 0.7
            lengths = np.linalg.norm(units, axis=1)[:, None] * np.linalg.norm(units[:40], axis=1)
            assert (high - low).mean() < 1.5 * lengths.mean()


@pytest.mark.parametrize("n", [1, 4, 5, 6, 40])
def test_leaders_keep_the_first_five(n):
    rng = random.Random(n)
    rows = [(rng.randrange(3), rng.randrange(4), i) for i in range(n)]
    leaders = m._Leaders(3)
    for i in range(0, n, 7):
        part = np.array(rows[i : i + 7], np.int64)
        leaders.add(part[:, 0], part[:, 1], part[:, 2])
    for of in range(3):
        best = sorted(((s, i) for x, s, i in rows if x == of), key=lambda x: (-x[0], x[1]))[:5]
        assert [(s, i) for x, s, i in zip(leaders.list, leaders.score, leaders.id) if x == of] == best
        assert leaders.fifth[of] == (best[4][0] if len(best) == 5 else -np.inf)
