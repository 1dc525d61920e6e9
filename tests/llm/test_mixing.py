from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from fractions import Fraction

import pytest

from quitanda.llm.mixing import mix, mixing_plan, source_targets
from tests.llm.helpers import DOCS, ODD_TEXTS, clashing, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_targets(sizes: dict, weights=(5, 2, 1), max_rate=3) -> dict:
    """Shares, with what is above a cap shared again until nothing is."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, budget = {}, set(order), Fraction(sum(sizes.values()))
    while open_:
        unit = budget / sum(weight[s] for s in open_)
        above = {s for s in open_ if unit * weight[s] >= max_rate * sizes[s]}
        if not above:
            return target | {s: unit * weight[s] for s in open_}
        for s in above:
            target[s] = Fraction(max_rate * sizes[s])
            budget -= target[s]
        open_ -= above
    return target


def brute_plan(rows, **options):
    sizes = Counter()
    for _, text, source in rows:
        sizes[source] += len(WORD.findall(text or ""))
    targets, found = brute_targets(dict(sizes), **options), []
    for key, text, source in rows:
        parts = ["mix-1", *(str(x) for x in (key, text) if x is not None)]
        u = int(hashlib.md5("|".join(parts).encode()).hexdigest()[:8], 16) / 2**32
        rate = targets[source] / sizes[source] if sizes[source] else Fraction(0)
        whole = math.floor(rate)
        copies = whole + (u < rate - whole)
        found.append((key, len(WORD.findall(text or "")), sizes[source], float(targets[source]), copies))
    return found


def table(spark, rows):
    return spark.createDataFrame([(k, t, "en", s, 0) for k, t, s in rows], DOCS)


ROWS = [(i, t, None if i % 3 == 0 else f"s{i % 3}") for i, t in enumerate(ODD_TEXTS)]
ROWS += [(100 + i, "w " * (i % 7), ["b", "B", "é", "\U0001F642", "�", "a", ""][i % 7]) for i in range(200)]
ROWS += [(7, "one two three", "b")] * 3 + [(None, "no key here", "a"), (None, None, None)]
ROWS += [(500 + i, None, "silent") for i in range(3)]


def test_plan_equals_brute_force(spark):
    plan = mixing_plan(table(spark, ROWS))
    assert plan.columns == ["doc_id", "size", "source_size", "target", "copies"]
    got, expected = rows_of(plan), sorted(brute_plan(ROWS), key=repr)
    assert [r[:3] + r[4:] for r in got] == [r[:3] + r[4:] for r in expected]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in expected])


def test_targets_above_the_cap_are_shared_again_in_turn(spark):
    sizes = {"a": 1, "b": 2, "c": 400, "d": 3, "e": 500, "f": 60, None: 0, "g": 10}
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")
    got = {r.source: r.target for r in source_targets(frame).collect()}
    assert got == pytest.approx({s: float(t) for s, t in brute_targets(sizes).items()})
    assert sum(got.values()) == pytest.approx(sum(sizes.values()))
    assert all(got[s] <= 3 * sizes[s] for s in sizes)


def test_taken_words_come_near_the_targets_and_reruns_agree(spark):
    rows = [(i, "w " * (1 + i * i % 37), f"s{min(i % 20, 12)}") for i in range(20_000)]
    docs = table(spark, rows)
    plan = mixing_plan(docs, keep=["doc_id", "source"]).toPandas()
    taken = (plan["size"] * plan["copies"]).groupby(plan["source"]).sum()
    target = plan.groupby("source")["target"].first()
    assert (abs(taken / target - 1) < 0.1).all()
    again = mixing_plan(docs.repartition(7), keep=["doc_id", "source"]).toPandas()
    order = ["doc_id", "copies"]
    assert plan[order].sort_values(order).values.tolist() == again[order].sort_values(order).values.tolist()
    other = mixing_plan(docs, seed="another").toPandas()
    assert other.sort_values("doc_id")["copies"].tolist() != plan.sort_values("doc_id")["copies"].tolist()


def test_mix_repeats_whole_rows(spark):
    docs = clashing(table(spark, ROWS)).withColumnRenamed("kept", "size").withColumnRenamed("n", "_copy")
    got = mix(docs)
    assert got.columns == docs.columns
    counted = Counter((r.doc_id, r.text) for r in got.collect())
    expected = Counter()
    for (key, text, _), row in zip(ROWS, brute_plan(ROWS)):
        expected[key, text] += row[4]
    assert counted == +expected


def test_tables_without_rows_or_words(spark):
    assert mixing_plan(table(spark, [])).collect() == []
    assert mix(table(spark, [])).collect() == []
    silent = table(spark, [(1, None, "a"), (2, " ", None)])
    assert rows_of(mixing_plan(silent)) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_many_sources_are_joined_like_few(spark, monkeypatch):
    import quitanda.operators.lookups as lookups

    docs = table(spark, ROWS)
    few = rows_of(mixing_plan(docs))
    monkeypatch.setattr(lookups, "BROADCAST_ROWS", 1)
    assert rows_of(mixing_plan(docs)) == few
