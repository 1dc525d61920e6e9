from __future__ import annotations

import random

import pytest

from quitanda.llm.licenses import TEMPLATES, Explainer, differences, scan_licenses, words_of
from tests.llm.helpers import ODD_TEXTS, clashing, docs_table


def found(spark, text):
    return [(r.license, r.exact, r.changes) for r in scan_licenses(docs_table(spark, [text])).collect()]


def test_every_template_finds_itself(spark):
    docs = docs_table(spark, [f"First line.\n{notice}\nLast." for notice in TEMPLATES.values()])
    rows = sorted(scan_licenses(docs).collect())
    assert [(r.license, r.exact, r.line) for r in rows] == [(name, True, 1) for name in TEMPLATES]
    assert all(0 < r.reduction < 1 for r in rows)


@pytest.mark.parametrize(
    "text, expected",
    [
        ("RELEASED under the  MIT license", [("MIT", True, [])]),
        (
            "This work is licensed under the GNU General Public License, version 3 or later.",
            [("GPL-3.0-only", True, [])],
        ),
        ("Released under the well known MIT License.", []),
        ("Copyright 2020, all rights reserved.", [(None, False, [])]),
        ("I have a driving license.", [(None, False, [])]),
        ("No cue here.", []),
    ],
)
def test_wording(spark, text, expected):
    rows = found(spark, text)
    if expected:
        assert rows == expected
    else:
        assert rows in ([], [("MIT", False, ["+well", "+known"])], [(None, False, [])])


def test_differences_are_exact():
    assert differences("licensed under the Apache License Version 2.0", TEMPLATES["Apache-2.0"]) == ([], [])
    assert differences("under the Apache License 1.1", "Apache License 2.0") == (["2.0"], [])


def test_long_lines_and_odd_texts(spark):
    notice = TEMPLATES["Apache-2.0"]
    rows = found(spark, "word " * 5000 + notice + " word" * 5000)
    assert ("Apache-2.0", True, []) in rows
    docs = clashing(docs_table(spark, [*ODD_TEXTS, notice]))
    assert [r.license for r in scan_licenses(docs.union(docs)).collect()] == ["Apache-2.0"] * 2
    assert scan_licenses(docs.limit(0)).collect() == []


def test_every_notice_is_found_over_line_breaks(spark):
    two = f"{TEMPLATES['MIT']} {TEMPLATES['Apache-2.0']}"
    assert found(spark, two) == [("MIT", True, []), ("Apache-2.0", True, [])]
    assert found(spark, "Released under\n * the MIT\n * License.") == [("MIT", True, [])]
    long = " ".join(f"w{i}" for i in range(300)) + " license"
    rows = scan_licenses(docs_table(spark, ["x " * 250 + long]), {"Long": long}).collect()
    assert [(r.license, r.exact) for r in rows] == [("Long", True)]


def test_the_template_that_explains_most_of_a_block_wins(spark):
    words = "this text may be used by anyone under the incomprehensibilities of our license"
    templates = {
        "few words differ": words.replace("incomprehensibilities ", ""),
        "few bytes differ": words.replace("may be ", ""),
    }
    rows = scan_licenses(docs_table(spark, [words]), templates).collect()
    assert [(r.license, r.changes) for r in rows] == [("few bytes differ", ["+may", "+be"])]


def test_nothing_is_confirmed_that_saves_nothing():
    explainer = Explainer(TEMPLATES)
    words = words_of(TEMPLATES["MIT"])
    assert [name for _, name, _ in explainer.notices(words, 0, len(words), lambda a, b: True)] == ["MIT"]
    explainer._reductions.ranked = lambda block: [(0, 0.0, name) for name in TEMPLATES]
    assert list(explainer.notices(words, 0, len(words), lambda a, b: True)) == []


def test_every_notice_saves_enough_in_any_block():
    explainer, rng = Explainer(TEMPLATES), random.Random(5)
    for _ in range(20):
        words, expected = [], []
        for name in rng.sample(list(TEMPLATES), len(TEMPLATES)):
            words += [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(0, 70))]
            notice = words_of(TEMPLATES[name])
            expected.append((0, len(words), len(words) + len(notice), name))
            words += notice
        found = explainer.notices(words, 0, len(words), lambda a, b: True)
        assert [(*match[:3], name) for match, name, _ in found] == expected
