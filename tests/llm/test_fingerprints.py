from __future__ import annotations

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quitanda.llm import fingerprints as P
from tests.llm.helpers import ODD_TEXTS, clashing, docs_table

PARAGRAPH = re.compile(r"[^\n]{80,}?[.!?](?= |\n|\Z)|[^\n]+")


def likeness(a, b):
    left, right = set(PARAGRAPH.findall(a)), set(PARAGRAPH.findall(b))
    return len(left & right) / len(left | right) if left | right else 1.0


def edited(a, b):
    half = len(a) // 2
    return a[: len(a) - half] + b[:half]


def check(spark, texts):
    rows = sorted(P.fingerprints(docs_table(spark, texts)).collect())
    assert [r.doc_id for r in rows] == list(range(len(texts)))
    whole = [t or "" for t in texts]
    for r in rows:
        own, following = whole[r.doc_id], whole[(r.doc_id + 1) % len(whole)]
        changed = edited(own, following)
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.near_edited == pytest.approx(likeness(own, changed))
        assert r.near_next == pytest.approx(likeness(own, following))
    by_text = {}
    for r in rows:
        assert by_text.setdefault(whole[r.doc_id], r.fingerprint) == r.fingerprint
    return rows


def test_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(P, "BUCKET_ROWS", 7)
    rng = random.Random(10)
    lines = [f"Line {i} of a text, " + "long words " * rng.randint(0, 12) + "ends here." for i in range(90)]
    texts = ["\n".join(rng.choices(lines, k=rng.randint(0, 60))) for _ in range(60)]
    texts += [texts[3], texts[3] + "\nand one line more", "\n".join(lines * 20)]
    check(spark, texts)


def test_odd_texts(spark):
    check(spark, ODD_TEXTS)
    check(spark, ["alone"])
    check(spark, ["", None])


def test_repeated_rows_and_clashing_columns(spark):
    docs = docs_table(spark, ["a\nb", "c\nd", "c\nd"]).withColumn("doc_id", F.lit(5).cast("bigint"))
    rows = P.fingerprints(clashing(docs)).collect()
    assert len(rows) == 3 and {r.doc_id for r in rows} == {5}
    assert P.fingerprints(docs.limit(0)).collect() == []


def test_null_doc_ids_stay(spark):
    docs = docs_table(spark, ["a", "b", "c"])
    docs = docs.withColumn("doc_id", F.when(F.col("doc_id") > 0, F.col("doc_id")))
    assert P.fingerprints(docs).count() == 3


@pytest.mark.parametrize("left, right", [(0, 0), (3, 0), (5, 5), (8, 8), (40, 10), (700, 600)])
def test_larger_sketches_recover_what_small_ones_cannot(spark, left, right):
    shared = [f"s{i}" for i in range(20)]
    a = shared + [f"a{i}" for i in range(left)]
    b = shared + [f"b{i}" for i in range(right)]
    row = spark.createDataFrame([("\n".join(a), "\n".join(b))], "a string, b string").select(
        P.larger_tries(P.digests(F.col("a")), P.digests(F.col("b"))).alias("found"),
        P.peeled(P.subtract(P.sketch(P.digests(F.col("a"))), P.sketch(P.digests(F.col("b"))))).alias("first"),
    ).first()
    assert row.found == left + right
    assert row.first in (None, left + right)
    assert (row.first is None) == (left + right > 20) or left + right <= 20


def test_no_python_in_the_plan(spark):
    plan = P.fingerprints(docs_table(spark, ["a", "b"]))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
