import random
import re

import pytest

from ledgerloom.llm import chosen_path, components
from tests.llm.helpers import awkward, documents, prose


def shingles(text, k):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, percent=80):
    sets = [(d, shingles(t, k)) for d, t in rows]
    parent = {i: i for i in range(len(sets))}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (d, a) in enumerate(sets):
        for j, (e, b) in enumerate(sets[:i]):
            if a and b and d is not None and e is not None and 100 * len(a & b) >= percent * len(a | b):
                parent[find(i)] = find(j)
    out = []
    for i, (d, a) in enumerate(sets):
        ids = [sets[j][0] for j in range(len(sets)) if find(j) == find(i)]
        component = None if d is None else min(ids)
        out.append((d, len(a), component, d is None or d == component))
    return sorted(out, key=repr)


def result(df):
    return sorted([(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in df.collect()], key=repr)


def edited(rng, words, share):
    return [w if rng.random() > share else "".join(rng.choice("klmn") for _ in range(5)) for w in words]


def family(rng, first, size, share, n=120):
    base = prose(rng, n).split()
    return [(first + i, " ".join(edited(rng, base, share))) for i in range(size)]


def test_groups_of_all_sizes(spark):
    rng = random.Random(8)
    rows = family(rng, 0, 90, 0.02) + family(rng, 200, 30, 0.04) + family(rng, 300, 12, 0.055) + family(rng, 400, 8, 0.07)
    rows += [(500 + i, prose(rng, rng.randint(1, 40))) for i in range(100)] + [(700 + i, rows[i][1].upper()) for i in range(0, 90, 9)]
    got = result(chosen_path.near_duplicates(documents(spark, rows), like=chosen_path.Likeness(2, 80)))
    assert got == brute(rows, 2)


@pytest.mark.parametrize("small,deepest", [(4, 4), (8, 2)])
def test_large_nodes_at_the_deepest_level(spark, small, deepest):
    """Leaders, and the comparison across components where branching ends."""
    rng = random.Random(9)
    rows = family(rng, 0, 60, 0.03) + family(rng, 100, 40, 0.06) + [(300 + i, prose(rng, 20)) for i in range(30)]
    got = result(chosen_path.near_duplicates(documents(spark, rows), like=chosen_path.Likeness(2, 80), small=small, deepest=deepest))
    assert got == brute(rows, 2)


def test_copies_leave_the_trees(spark, monkeypatch):
    """A large family is carried once, not at every level of every tree, and sets linked with its fringe only are still found."""
    rng = random.Random(14)
    base = prose(rng, 150, "abcdefghijklmnop").split()
    rows = [(i, " ".join(edited(rng, base, rng.choice((0.005, 0.01, 0.02, 0.04))))) for i in range(240)]
    for n in range(12):
        fringe = edited(rng, base, 0.06)
        rows += [(1000 + 2 * n, " ".join(fringe)), (1001 + 2 * n, " ".join(edited(rng, fringe, 0.05)))]
    carried = []
    plain = chosen_path._branched
    monkeypatch.setattr(chosen_path, "_branched", lambda rows, levels, trees=0: carried.append(0 if trees else rows.count()) or plain(rows, levels, trees))
    got = result(chosen_path.near_duplicates(documents(spark, rows), like=chosen_path.Likeness(2, 80)))
    assert got == brute(rows, 2)
    assert sum(carried) < 240 * chosen_path.TREES


def test_differences_tell_all_links_with_followers():
    """A set linked with a follower, but not with its pivot, shares one of the follower's first differences."""
    rng = random.Random(15)
    base = set(range(200))
    near = lambda most: frozenset((base - set(rng.sample(range(200), rng.randint(0, most)))) | {rng.randrange(200, 240) for _ in range(rng.randint(0, most))})
    sets, met = [near(30) for _ in range(150)], 0
    for pivot in sets[:5]:
        for x in sets:
            for y in sets:
                more, less, apart = len(y - pivot), len(pivot - y), (x ^ pivot) & (y ^ pivot)
                linked = lambda a, b: 100 * len(a & b) >= 80 * len(a | b)
                if linked(x, y) and not linked(x, pivot):
                    met += 1
                    assert len(apart) > (80 * more + 100 * less) // 180
                    assert len(apart) >= -(-(180 * (len(x ^ pivot) + len(y ^ pivot)) - 20 * (len(x) + len(y))) // 360)
    assert met > 100


def test_bridges_between_followers_of_unlike_leaders(spark):
    """Two linked sets, each linked with a set of its own; those two have a similarity of 0.5."""
    rng = random.Random(10)
    rows = []
    for n in range(40):
        base = [f"b{n}w{i}" for i in range(100)]
        places = rng.sample(range(100), 31)
        one = list(base)
        other = [f"o{n}w{i}" if i in places[:9] else w for i, w in enumerate(base)]
        led = [[f"l{side}{n}w{i}" if i in at else w for i, w in enumerate(words)] for side, (words, at) in enumerate([(one, places[9:20]), (other, places[20:31])])]
        rows += [(4 * n + i, " ".join(words)) for i, words in enumerate([one, other, *led])]
    got = result(chosen_path.near_duplicates(documents(spark, rows), like=chosen_path.Likeness(1, 80), small=1))
    assert got == brute(rows, 1)


def test_awkward_rows(spark):
    rows = awkward()
    for k in (2, 5):
        assert result(chosen_path.near_duplicates(documents(spark, rows), like=chosen_path.Likeness(k, 80))) == brute(rows, k)
    assert chosen_path.near_duplicates(documents(spark, [])).collect() == []


def test_threshold_is_exact(spark):
    shared = [f"w{i}" for i in range(41)]
    at = [(1, " ".join(shared)), (2, " ".join(shared[:33]))]  # 32 of 40 shingles: exactly 0.8
    under = [(3, " ".join("x" + w for w in shared)), (4, " ".join("x" + w for w in shared[:32]))]
    got = {r[0]: r[2] for r in result(chosen_path.near_duplicates(documents(spark, at + under), like=chosen_path.Likeness(2, 80)))}
    assert got == {1: 1, 2: 1, 3: 3, 4: 4}


def test_sketch_cut():
    assert chosen_path.largest_distance(80) == 45 and chosen_path.largest_distance(80, 0.0) == 26 and chosen_path.reach(80) == 60


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(200, 201), (201, 202), (202, 200)]
    got = {r.node: r.root for r in components.connected(spark.createDataFrame(links, "a int, b int")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {i: 200 for i in (200, 201, 202)}
    assert components.connected(spark.createDataFrame([], "a int, b int")).collect() == []
