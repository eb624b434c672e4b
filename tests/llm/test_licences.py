import math
import random

import pytest

from ledgerloom.llm import licences
from tests.llm.helpers import awkward, documents, prose


@pytest.fixture(scope="module")
def model(spark):
    rng = random.Random(2)
    return licences.learn(documents(spark, [(i, prose(rng, 30)) for i in range(300)]))


def brute(model, line):
    grams = licences.ngrams_of(licences.words_of(line))
    logits = [(c + sum(model.weights[g][i] for g in grams if g in model.weights)) / model.temperature for i, c in enumerate(model.constant)]
    top = max(logits)
    total = sum(math.exp(x - top) for x in logits)
    likely = [math.exp(x - top) / total for x in logits]
    known = likely[: len(licences.NOTICES)]
    if max(known) >= licences.LEAST_PROBABILITY:
        return model.families[known.index(max(known))], max(known)
    if 1 - likely[-1] >= licences.LEAST_PROBABILITY:
        return licences.UNKNOWN, 1 - likely[-1]
    return licences.NONE, likely[-1]


def test_notices_in_documents(spark, model):
    rng = random.Random(3)
    rows, expected = [], {}
    for family, notices in licences.NOTICES.items():
        for notice in notices:
            rows.append((len(rows), prose(rng, 20) + "\n" + notice + "\n" + prose(rng, 20)))
            expected[rows[-1][0]] = family
    rows += [(1000, prose(rng, 50)), (1001, "the mit der und mit"), (1002, "a licensed driver and the permission of the gnu herd")]
    got = {r.doc_id: r for r in licences.scan(documents(spark, rows), model=model).collect()}
    assert {i: got[i].family for i in expected} == expected
    assert all(got[i].confirmed for i in expected)
    assert {got[i].family for i in (1000, 1001)} == {"none"} and not got[1002].confirmed


def test_scores_equal_brute_force(spark, model):
    lines = [n for notices in licences.NOTICES.values() for n in notices] + ["reserved reserved rights", "copyright law", "released under the new license"]
    docs = documents(spark, [(i, line) for i, line in enumerate(lines)])
    got = {r.doc_id: r for r in licences.licence_paragraphs(docs, model).collect()}
    for i, line in enumerate(lines):
        family, probability = brute(model, line)
        if family != licences.NONE:
            assert got[i].family == family and math.isclose(got[i].probability, probability, rel_tol=1e-9)
        else:
            assert i not in got


def test_held_out_accuracy(model):
    held = [(line, family) for line, family, is_held in licences.training_lines(seed=77) if is_held]
    right = sum(brute(model, line)[0] == family for line, family in held)
    assert right / len(held) > 0.93


def test_awkward_rows(spark, model):
    rows = awkward() + [(20, "Released under the MIT License."), (20, "Released under the MIT License."), (None, "All rights reserved.")]
    got = licences.scan(documents(spark, rows), model=model).collect()
    assert len(got) == len(rows)
    assert sorted([(r.doc_id, r.family) for r in got if r.family != "none"], key=repr) == [(20, "mit"), (20, "mit"), (None, "all-rights-reserved")]
    assert licences.scan(documents(spark, []), model=model).collect() == []
    assert licences.scan(documents(spark, [])).collect() == []


def scanned(spark, model, *texts):
    rng = random.Random(4)
    around = lambda: "\n".join(prose(rng, 9) for _ in range(9))
    rows = [(i, f"{around()}\n{text}\n{around()}") for i, text in enumerate(texts)]
    return [r for r in sorted(licences.scan(documents(spark, rows), model=model).collect())]


def wrapped(text, width):
    words = text.split()
    return "\n".join(" ".join(words[i : i + width]) for i in range(0, len(words), width))


def test_notices_wrapped_over_lines_are_one_paragraph(spark, model):
    got = scanned(
        spark, model,
        wrapped(licences.NOTICES["mit"][2], 6), wrapped(licences.NOTICES["gpl"][1], 9), wrapped(licences.NOTICES["apache"][1], 7), wrapped(licences.NOTICES["bsd"][1], 5),
    )
    assert [(r.family, r.confirmed, r.n_paragraphs) for r in got] == [(f, True, 1) for f in ("mit", "gpl", "apache", "bsd")]


def test_other_licences_are_unknown_and_never_confirmed(spark, model):
    got = scanned(
        spark, model,
        "Licensed under the GNU Affero General Public License v3.", "Licensed under the Eclipse Public License", "THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY",
        wrapped(licences.OTHERS["zlib"][1], 7), wrapped(licences.OTHERS["isc"][1], 7), "This file is distributed under the terms of the Quorvex License, version 2.",
    )
    assert [(r.family, r.confirmed, r.n_paragraphs) for r in got] == [("unknown", False, 1)] * 6
    assert scanned(spark, model, "no statement at all")[0].family == "none"


def test_blank_lines_part_paragraphs(spark, model):
    got = scanned(spark, model, "Released under the MIT License.\n \t\nLicensed under the BSD 3-Clause License.")
    assert got[0].n_paragraphs == 2 and got[0].confirmed


def test_precision_and_recall_on_variants_not_seen(model):
    held = [(line, family) for seed in range(78, 86) for line, family, is_held in licences.training_lines(seed=seed) if is_held]
    told = [(brute(model, line)[0], family) for line, family in held]
    figures = {}
    for family in model.families:
        claimed = [own for said, own in told if said == family]
        there = [said for said, own in told if own == family]
        figures[family] = round(sum(own == family for own in claimed) / len(claimed), 3), round(sum(said == family for said in there) / len(there), 3)
    print("precision and recall by family:", figures)
    assert all(min(pair) >= 0.8 for pair in figures.values()), figures
