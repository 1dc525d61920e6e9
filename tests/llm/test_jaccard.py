from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quitanda.llm import jaccard as J
from quitanda.llm.components import components
from tests.llm.helpers import ODD_TEXTS, clashing, docs_table


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def brute(texts, width, num):
    sets = [shingles(t, width) for t in texts]
    least = list(range(len(texts)))

    def root(i):
        return i if least[i] == i else root(least[i])

    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= num * len(a | sets[j]):
                x, y = sorted((root(i), root(j)))
                least[y] = x
    return [(i, len(sets[i]), root(i)) for i in range(len(texts))]


def near_copies(seed, n, words):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(words)]
    texts = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randint(0, 6)):
            copy[rng.randrange(len(copy))] = f"e{rng.randint(0, 10**6)}"
        if rng.random() < 0.3:
            del copy[: rng.randint(0, 12)]
        texts.append(" ".join(copy))
    return texts


@pytest.mark.parametrize("width, num", [(3, 90), (5, 80)])
@pytest.mark.parametrize(
    "block_rows, parts, share, combined",
    [(1000, 16, 2.0**-16, 256), (20, 16, 1e-4, 256), (10, 2, 1e-4, 100)],
)
def test_equal_brute_force(spark, monkeypatch, width, num, block_rows, parts, share, combined):
    monkeypatch.setattr(J, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(J, "FAMILY_PARTS", parts)
    monkeypatch.setattr(J, "FREQUENT_SHARE", share)
    monkeypatch.setattr(J, "COMBINED_SIZE", combined)
    texts = near_copies(1, 60, 150) + near_copies(2, 30, 40) + near_copies(3, 12, 400)
    texts += ["A few Words", "a few words", "a few", "few", "few", "", None, "a few words more"]
    random.Random(11).shuffle(texts)
    found = J.jaccard_components(docs_table(spark, texts), width, num)
    assert sorted(map(tuple, found.collect())) == brute(texts, width, num)


def test_odd_texts(spark):
    docs = clashing(docs_table(spark, ODD_TEXTS))
    found = J.jaccard_components(docs, 3, 90)
    assert sorted(map(tuple, found.collect())) == brute(ODD_TEXTS, 3, 90)
    assert J.jaccard_components(docs.limit(0)).collect() == []
    assert J.jaccard_components(docs.union(docs)).count() == 2 * len(ODD_TEXTS)


def test_null_keys_stay(spark):
    docs = docs_table(spark, ["a b c", "a b c", "d"])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") != 1, F.col("doc_id")))
    rows = J.jaccard_components(docs).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows if r.doc_id is not None) == [(0, 0), (2, 2)]
    assert [r.component_id for r in rows if r.doc_id is None] == [0]


def test_summary_keeps_what_is_frequent(monkeypatch):
    monkeypatch.setattr(J, "_SUMMARY", 16)
    rng, summary, true = random.Random(12), J.Summary(), {}
    for _ in range(50):
        part = [rng.choice([1, 2, 3]) if rng.random() < 0.5 else rng.randint(4, 10**6) for _ in range(200)]
        summary.add(np.array(part, np.uint64))
        summary.merge()
        for h in part:
            true[h] = true.get(h, 0) + 1
    found = dict(zip(summary.hashes.tolist(), summary.counts.tolist()))
    assert len(found) <= 16
    for h in (1, 2, 3):
        assert true[h] - 10_000 / 16 <= found.get(h, 0) <= true[h]


def test_components_of_chains_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 120)] + [(7, 7), (50, 51), (51, 50)]
    found = components(spark.createDataFrame(links, "a bigint, b bigint"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, **{i: 100 for i in range(101, 120)}, 51: 50}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_frequent_shingles_are_counted_over_all_documents(spark, monkeypatch):
    monkeypatch.setattr(J, "FREQUENT_SHARE", 1e-3)
    texts = [f"a{i} b{i} c{i}" if i % 20 else f"a{i} said and done" for i in range(1000)]
    docs = docs_table(spark, texts)
    found = J.members_and_prefixes(docs.repartition(3), 3, 90, 100, "doc_id", "text")
    hashes, order = J.frequent_shingles(found)
    assert hashes.tolist() == J.Shingler(3)("said and done").tolist()
    assert order.tolist() == [0]


def test_a_task_adds_one_row_of_counts(spark, monkeypatch):
    monkeypatch.setattr(J, "FREQUENT_SHARE", 1e-3)
    monkeypatch.setattr(J, "_SUMMARIES", 3)
    texts = [f"a{i} b{i} c{i}" if i % 20 else f"a{i} said and done" for i in range(1000)]
    docs = docs_table(spark, texts).repartition(20)
    found = J.members_and_prefixes(docs, 3, 90, 100, "doc_id", "text")
    assert found.count() <= 1000 + 20
    hashes, order = J.frequent_shingles(found)
    assert hashes.tolist() == J.Shingler(3)("said and done").tolist() and order.tolist() == [0]
    assert J.frequent_shingles(found.limit(0))[0].tolist() == []


def test_added_summaries_miss_a_bounded_share(monkeypatch):
    monkeypatch.setattr(J, "_SUMMARY", 64)
    rng, whole, true = random.Random(15), J.Summary(), {}
    for _ in range(40):
        part = [rng.choice([1, 2, 3]) if rng.random() < 0.3 else rng.randint(4, 10**6) for _ in range(200)]
        task = J.Summary()
        task.add(np.array(part, np.uint64))
        task.shorten(6)
        whole.add_summary(task.total, task.missed, task.hashes, task.counts)
        for h in part:
            true[h] = true.get(h, 0) + 1
    assert whole.total == 8_000 and whole.missed <= 8_000 >> 5 and len(whole.hashes) <= 64
    found = dict(zip(whole.hashes.tolist(), whole.counts.tolist()))
    assert all(true[h] - whole.missed <= found.get(h, 0) <= true[h] for h in true)


def test_counts_are_too_low_by_a_bounded_share(monkeypatch):
    monkeypatch.setattr(J, "_SUMMARY", 64)
    rng, summary, true = random.Random(13), J.Summary(), {}
    for _ in range(40):
        part = [rng.choice([1, 2, 3]) if rng.random() < 0.3 else rng.randint(4, 10**6) for _ in range(200)]
        summary.add(np.array(part, np.uint64))
        summary.merge()
        for h in part:
            true[h] = true.get(h, 0) + 1
    summary.shorten(5)
    assert summary.total == 8_000 and summary.missed <= 8_000 >> 5
    found = dict(zip(summary.hashes.tolist(), summary.counts.tolist()))
    assert set(found) == {1, 2, 3}
    assert all(true[h] - summary.missed <= n <= true[h] for h, n in found.items())


@pytest.mark.parametrize("num", [80, 90])
def test_similar_sets_share_enough_of_their_prefixes(num):
    rng = random.Random(14)
    for _ in range(300):
        n = rng.randint(1, 300)
        a = np.unique(np.array([rng.getrandbits(64) for _ in range(n)], np.uint64))
        kept = rng.sample(a.tolist(), J.least_overlap(len(a), num, 100))
        room = len(kept) * 100 // num - len(a)
        more = [rng.getrandbits(64) for _ in range(rng.randint(0, max(0, room)))]
        b = np.unique(np.array(kept + more, np.uint64))
        both, either = len(np.intersect1d(a, b)), len(np.union1d(a, b))
        if 100 * both < num * either:
            continue
        (x, need_x), (y, need_y) = J.signatures(a, num, 100), J.signatures(b, num, 100)
        assert len(np.intersect1d(x, y)) >= max(need_x, need_y)
