from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pytest

from quitanda.llm import queries
from quitanda.llm.periods import find_runs, frequent_segments, most_repeated, periodic_runs
from tests.llm.helpers import ODD_TEXTS, clashing, docs_table, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.001"


def brute_runs(words, min_length=24, min_periods=3):
    """Each lag in turn; of lags with the same stretch the smallest is its period."""
    found = {}
    for q in range(1, len(words) // min_periods + 1):
        i = 0
        while i < len(words) - q:
            end = i
            while end < len(words) - q and words[end] == words[end + q]:
                end += 1
            if end > i and end - i + q >= max(min_length, min_periods * q):
                found.setdefault((i, end - i + q), q)
            i = max(end, i + 1)
    return sorted((start, length, q) for (start, length), q in found.items())


def brute_row(words):
    runs = brute_runs(words)
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else None
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return runs, best, kept


def with_runs(rng, n):
    words = [f"w{rng.randrange(rng.choice([1, 2, 3, 40]))}" for _ in range(n)]
    for _ in range(rng.randint(0, 3)):
        a = rng.randrange(n)
        p, b = rng.randint(1, max(1, (n - a) // 3)), rng.randint(a, n)
        words[a:b] = [words[a + i % p] for i in range(b - a)]
    return words


def numbers(words):
    ids = {}
    return np.array([ids.setdefault(w, len(ids)) for w in words], np.int64)


def test_runs_equal_brute_force():
    rng, seen = random.Random(7), 0
    for _ in range(1500):
        words = with_runs(rng, rng.randint(1, 150))
        for least in (24, 5):
            expected = brute_runs(words, least)
            assert find_runs(numbers(words), (), least) == expected
            seen += len(expected)
    assert seen > 500


def test_a_rare_word_splits_until_nothing_changes():
    # y is often enough in the whole, but not in either part that x leaves of it.
    words = ["a"] * 30 + ["y", "x", "y", "y"] + ["a"] * 30
    assert frequent_segments(numbers(words)) == [(0, 30), (34, 64)]
    assert frequent_segments(numbers(["a", "b"] * 30)) == [(0, 60)]
    assert frequent_segments(numbers(["a", "b"] * 30), breaks=[30]) == [(0, 30), (30, 60)]
    assert frequent_segments(numbers(["a", "b", "c"])) == []
    assert frequent_segments(numbers([])) == []


def test_the_most_repeated_run_is_compared_exactly():
    assert most_repeated([]) is None
    assert most_repeated([(5, 30, 10), (1, 24, 8), (1, 24, 1)]) == (1, 24, 1)
    assert most_repeated([(9, 30, 10), (5, 24, 8)]) == (5, 24, 8)
    large = 10**15
    assert most_repeated([(0, 3 * large, large), (9, 3 * large + 1, large)]) == (9, 3 * large + 1, large)


def test_texts_of_a_table(spark):
    rng = random.Random(3)
    texts = [" ".join(with_runs(rng, 80)) for _ in range(300)] + ODD_TEXTS
    texts += ["x\n" * 24, "x " * 23, "　a b\t" * 9, "same " * 30, "same " * 30, "é 🙂 " * 5000]
    found = periodic_runs(clashing(docs_table(spark, texts)), keep=["doc_id", "kept"]).collect()
    assert len(found) == len(texts)
    for row in found:
        runs, best, kept = brute_row(WORD.findall(texts[row.doc_id] or ""))
        assert row.kept == "x"
        assert [tuple(r) for r in row.runs] == runs
        assert (row.most_repeated and tuple(row.most_repeated)) == best
        assert row.collapsed == kept


def test_an_empty_table_has_no_rows(spark):
    assert periodic_runs(docs_table(spark, [])).collect() == []


def planted(doc_id, text):
    words = WORD.findall(text or "")
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def expected_rows(rows):
    def sha(text):
        return hashlib.sha256(text.encode()).hexdigest()

    for doc_id, text in rows:
        runs, best, kept = brute_row(planted(doc_id, text))
        first = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        yield (doc_id, len(runs), *first, sha(lines), sha(kept))


@pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="test tables not present")
def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    got = queries.op12_periodic_runs(spark, SF_DIR)
    assert [f.dataType.simpleString() for f in got.schema] == ["bigint"] * 6 + ["string"] * 2
    assert rows_of(got) == sorted(expected_rows(docs), key=repr)
    assert got.where("n_runs > 0").count() > 10


def test_query_on_odd_rows(spark, tmp_path):
    rng = random.Random(11)
    texts = ODD_TEXTS + ["one two " * 20] * 40 + [" ".join(with_runs(rng, 60)) for _ in range(100)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "a " * 30), (None, None), (3, "b " * 25)]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(queries.op12_periodic_runs(spark, str(tmp_path)))
    assert got == sorted(expected_rows(rows), key=repr)
