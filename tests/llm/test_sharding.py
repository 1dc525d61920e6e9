from __future__ import annotations

import random
import zlib

import pytest

from quitanda.llm import sharding
from quitanda.llm.sharding import document_shards
from tests.llm.helpers import ODD_TEXTS, clashing, docs_table


def check(rows, shards=40):
    for shard in range(shards):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert all(0 <= r.shard < shards for r in rows)
    return [sum(r["size"] for r in rows if r.shard == s) for s in range(shards)]


def test_equal_bytes_and_whole_groups(spark):
    random.seed(9)
    texts = ["x" * random.randint(0, 400) + str(i % 3000) for i in range(4000)]
    texts += [texts[0]] * 5 + [texts[1]] * 3
    rows = document_shards(docs_table(spark, texts)).collect()
    assert len(rows) == len(texts)
    sizes = check(rows)
    mean = sum(sizes) / 40
    assert max(sizes) <= 1.1 * mean and min(sizes) >= 0.9 * mean
    for r in rows:
        raw = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32) == (len(raw) + 16, zlib.crc32(raw))


def test_small_groups_stay_whole(spark):
    texts = [f"text number {i // 2} " * 3 for i in range(20_000)]
    rows = document_shards(docs_table(spark, texts)).collect()
    where = {}
    for r in rows:
        where.setdefault(texts[r.doc_id], set()).add(r.shard)
    assert all(len(shards) == 1 for shards in where.values())


def test_a_group_of_a_third_of_the_rows_is_split(spark):
    texts = ["one and the same text"] * 2000 + [f"text {i} of its own" for i in range(4000)]
    sizes = check(document_shards(docs_table(spark, texts)).collect())
    mean = sum(sizes) / 40
    assert max(sizes) <= 1.15 * mean and min(sizes) >= 0.85 * mean


def test_slots_in_many_parts(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SLOT_ROWS", 3)
    check(document_shards(docs_table(spark, [f"t{i}" for i in range(500)])).collect())


def test_odd_texts_repeats_and_empty_tables(spark):
    docs = docs_table(spark, ODD_TEXTS)
    rows = document_shards(clashing(docs).union(clashing(docs))).collect()
    assert len(rows) == 2 * len(ODD_TEXTS)
    check(rows)
    assert {r["size"] for r in rows if r.doc_id in (0, 1)} == {16}
    assert {r.text_crc32 for r in rows if r.doc_id in (0, 1)} == {0}
    assert document_shards(docs.limit(0)).collect() == []
    assert len(document_shards(docs_table(spark, ["alone"])).collect()) == 1


@pytest.mark.parametrize("shards", [1, 2, 7])
def test_other_numbers_of_shards(spark, shards):
    docs = docs_table(spark, [f"text {i}" * (i % 9) for i in range(700)])
    check(document_shards(docs, shards).collect(), shards)
