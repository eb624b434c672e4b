import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from ledgerloom.llm import bk_simhash as m
from tests.llm.helpers import awkward, documents, prose


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda c: c.group().lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    codes = [plain_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(codes):
            for j, b in enumerate(codes):
                if (a ^ b).bit_count() <= 2 and label[j] < label[i]:
                    label[i], changed = label[j], True
    ids = {}
    for (doc, _), of in zip(rows, label):
        ids[of] = min((x for x in (ids.get(of), doc) if x is not None), default=None)
    return sorted(((doc, f"{c:016x}", ids[of]) for (doc, _), c, of in zip(rows, codes, label)), key=repr)


def test_against_brute_force(spark):
    rng = random.Random(4)
    rows = [r for r in awkward() if len(r[1] or "") < 1000]
    for i in range(40):
        words = prose(rng, rng.randint(1, 300)).split()
        rows.append((100 + i * 10, " ".join(words)))
        for k in range(1, 6):
            other = list(words)
            for _ in range(k - 1):
                other[rng.randrange(len(other))] = "Changed"
            rows.append((100 + i * 10 + k, "\t".join(other).upper() if k % 2 else " ".join(other)))
    got = sorted(map(tuple, m.near_duplicates(documents(spark, rows)).collect()), key=repr)
    assert got == plain_components(rows)
    # Hot blocks cut up again and again give the same.
    assert sorted(map(tuple, m.near_duplicates(documents(spark, rows), largest=3).collect()), key=repr) == got


def test_hash_is_that_of_spark(spark):
    word = "naïve 日本 ok"
    assert spark.range(1).select(F.xxhash64(F.lit(word))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(word.encode(), 42)


def test_long_and_awkward_texts(spark):
    rows = awkward()
    got = {(r[0], r[1]) for r in m.near_duplicates(documents(spark, rows)).collect()}
    assert got == {(d, f"{plain_fingerprint(t):016x}") for d, t in rows}


def test_empty_table(spark):
    assert m.near_duplicates(documents(spark, [])).collect() == []


def test_null_ids_link_but_name_nothing(spark):
    rows = [(None, "a b c d"), (5, "a b c d"), (9, "a b c d"), (None, "quite another text")]
    got = m.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r[0], r[2]) for r in got if r[0]) == [(5, 5), (9, 5)]
    assert {r[2] for r in got if r[0] is None} == {5, None}


def test_tree_finds_what_a_scan_finds():
    rng = np.random.default_rng(1)
    codes = np.unique(rng.integers(0, 1 << 12, 700, dtype=np.uint64) * np.uint64(0x0010010010010011))
    tree = m.BkTree(codes)
    for radius in (0, 2, 5):
        query, node = tree.search(codes, radius)
        near = np.bitwise_count(codes[:, None] ^ codes[None, :]) <= radius
        assert sorted(zip(query, node)) == sorted(zip(*np.nonzero(near)))


def test_tree_follows_few_edges():
    codes = np.random.default_rng(2).integers(0, 1 << 63, 5000, dtype=np.uint64)
    tree = m.BkTree(codes)
    query, node = np.zeros(1, np.int64), np.zeros(1, np.int64)
    visited = 0
    while len(node):
        visited += len(node)
        distance = np.bitwise_count(codes[7] ^ codes[node]).astype(int)
        spans = [(np.searchsorted(tree.edges, n * 65 + max(d - 2, 0)), np.searchsorted(tree.edges, n * 65 + d + 2, "right")) for n, d in zip(node, distance)]
        node = np.concatenate([tree.children[a:b] for a, b in spans])
    assert visited < 1500 and len(query) == 1


def test_near_codes_share_a_block_however_hot(spark):
    rng = random.Random(6)
    centre = rng.getrandbits(64)
    codes = {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3))) for _ in range(400)}
    signed = [(c - (1 << 64) if c >> 63 else c,) for c in codes]
    entries = m.shard_entries(spark.createDataFrame(signed, "code bigint"), 20).collect()
    groups = {}
    for mask, block, code in entries:
        groups.setdefault((mask, block), set()).add(code)
    assert max(map(len, groups.values())) <= 20
    for a in signed:
        for b in signed:
            if ((a[0] ^ b[0]) & (1 << 64) - 1).bit_count() <= 2:
                assert any(a[0] in g and b[0] in g for g in groups.values())
