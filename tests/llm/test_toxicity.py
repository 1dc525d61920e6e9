from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quitanda.llm import toxicity as T
from tests.llm.helpers import ODD_TEXTS, clashing, docs_table


def brute_ratios(rows):
    """Both models of (text, toxic) rows by their definition: (context, next) to the ratio."""
    counts = {0: Counter(), 1: Counter()}
    for text, toxic in rows:
        for word in T.words_in(text):
            padded = chr(1) * (T.ORDER - 1) + word + chr(2)
            for i in range(T.ORDER - 1, len(padded)):
                counts[toxic][padded[i - T.ORDER + 1 : i + 1]] += 1
    types = {T.ORDER: set(counts[0]) | set(counts[1])}
    seen = {}
    for k in range(T.ORDER - 1, 0, -1):
        seen[k] = Counter(gram[1:] for gram in types[k + 1])
        types[k] = set(seen[k])

    def shared(gram):
        k = len(gram)
        after = [g for g in types[k] if g[:-1] == gram[:-1]]
        total = sum(seen[k][g] for g in after)
        if k == 1:
            return seen[1][gram] / total
        direct = max(seen[k][gram] - T.DISCOUNT, 0) / total
        return direct + T.DISCOUNT * len(after) / total * shared(gram[1:])

    ratios = {}
    for gram in types[T.ORDER]:
        logs = []
        for toxic in (1, 0):
            after = [g for g in counts[toxic] if g[:-1] == gram[:-1]]
            total = sum(counts[toxic][g] for g in after)
            p = shared(gram[1:])
            if total:
                direct = max(counts[toxic][gram] - T.DISCOUNT, 0) / total
                p = direct + T.DISCOUNT * len(after) / total * p
            logs.append(math.log(p))
        ratios[gram] = logs[0] - logs[1]
    return ratios


def test_ratios_equal_the_definition(spark):
    rows = [("good words go on", 0), ("bad words are bad", 1), ("go good", 0), ("bäd", 1), (None, 0)]
    model = T.train_evidence(spark.createDataFrame(rows, "text string, toxic int"))
    ratios = brute_ratios(rows)
    for word in ("good", "bad", "words", "bäd"):
        padded = chr(1) * (T.ORDER - 1) + word + chr(2)
        grams = [padded[i : i + T.ORDER] for i in range(len(word) + 1)]
        expected = sum(ratios[gram] for gram in grams)
        assert model.evidence([word])[0] == pytest.approx(expected, abs=1e-4)
    assert model.evidence(["zzz"])[0] == pytest.approx(model.evidence(["zzzzzz"])[0], abs=1e-6)


def made_up(n, seed):
    rng = random.Random(seed)
    calm = ["".join(rng.choices(["ta", "ri", "no", "le", "su"], k=rng.randint(1, 4))) for _ in range(300)]
    harsh = ["grokzad", "vumpik", "zaxxor"]
    texts, labels = [], []
    for _ in range(n):
        toxic = rng.random() < 0.2
        words = rng.choices(calm, k=rng.randint(5, 60))
        if toxic:
            words += rng.choices(harsh, k=rng.randint(1, 5))
        rng.shuffle(words)
        texts.append(" ".join(words))
        labels.append(int(toxic))
    return texts, labels


def labels_table(spark, labels):
    return spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")


def test_held_out_texts_are_told_apart(spark):
    texts, labels = made_up(1500, 3)
    docs = docs_table(spark, texts)
    model = T.train(docs, labels_table(spark, labels))
    scored = T.score(docs, model).withColumn("held", T.fold_of(F.col("doc_id")) == T.HELD_OUT)
    held = [r for r in scored.collect() if r.held]
    wrong = [r for r in held if (r.score >= T.THRESHOLD) != bool(labels[r.doc_id])]
    assert len(held) > 200 and len(wrong) <= 0.03 * len(held)


def test_held_out_labels_are_never_used(spark):
    texts, labels = made_up(300, 4)
    docs = docs_table(spark, texts)
    table = labels_table(spark, labels)
    held = T.fold_of(F.col("doc_id")) == T.HELD_OUT
    turned = table.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    one, other = (T.score(docs, T.train(docs, t)).collect() for t in (table, turned))
    by_id = {r.doc_id: r.score for r in other}
    assert all(r.score == pytest.approx(by_id[r.doc_id], abs=1e-9) for r in one)


@pytest.mark.parametrize("labels", [[], [None] * 11, [0] * 11, [1] * 11])
def test_odd_texts_and_poor_labels(spark, labels):
    docs = clashing(docs_table(spark, ODD_TEXTS))
    table = spark.createDataFrame(list(enumerate(labels)), "doc_id bigint, toxic int")
    rows = T.score(docs.union(docs), T.train(docs, table), docs.columns, name="mark").collect()
    assert len(rows) == 2 * len(ODD_TEXTS)
    assert all(0 <= r.mark <= 1 for r in rows)
    scores = defaultdict(set)
    for r in rows:
        scores[r.text].add(r.mark)
    assert all(len(found) == 1 for found in scores.values())


def test_empty_tables(spark):
    docs = docs_table(spark, [])
    assert T.score(docs, T.train(docs, labels_table(spark, [0, 1]))).count() == 0


def test_grams_of_words_do_not_depend_on_their_neighbours():
    together = T.grams_of(["ab", "", "abc"])
    alone = [T.grams_of([w]) for w in ("ab", "", "abc")]
    assert np.array_equal(together[1], np.concatenate([a[1] for a in alone], axis=1))
    assert np.array_equal(together[2], np.concatenate([a[2] for a in alone], axis=1))


def test_no_expression_is_lost_to_another(spark):
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=5)) for _ in range(3000)]
    at, seen, pair = T.grams_of(words), {}, None
    for owner, gram in zip(at[0], at[1][-1]):
        other = seen.setdefault(int(gram) % 2**20, (owner, gram))
        if other[1] != gram and other[0] != owner:
            pair = words[other[0]], words[owner]
    rows = [(pair[0], 0), (f"{pair[0]} {pair[1]}", 0), (pair[1], 1), (f"{pair[1]} on", 1)]
    model = T.train_evidence(spark.createDataFrame(rows, "text string, toxic int"))
    ratios = brute_ratios(rows)
    for word in pair:
        padded = chr(1) * (T.ORDER - 1) + word + chr(2)
        expected = sum(ratios[padded[i : i + T.ORDER]] for i in range(len(word) + 1))
        assert model.evidence([word])[0] == pytest.approx(expected, abs=1e-4)


def test_scores_do_not_depend_on_blocks(spark, monkeypatch):
    texts, labels = made_up(200, 6)
    docs = docs_table(spark, texts)
    model = T.train(docs, labels_table(spark, labels))
    whole = dict(T.score(docs, model).collect())
    monkeypatch.setattr(T, "BLOCK_WORDS", 20)
    assert dict(T.score(docs, model).collect()) == pytest.approx(whole)
    by_hand = {}
    for i, text in enumerate(texts[:3]):
        words = T.words_in(text)
        lengths = np.array([len(w) for w in words])
        by_hand[i] = model.probability(T.features_of(model.evidence.evidence(words), lengths))
    assert {i: whole[i] for i in by_hand} == pytest.approx(by_hand)


@pytest.mark.parametrize("calibration_rows", [20, T.CALIBRATION_ROWS])
def test_labels_of_the_calibration_fold_are_counted(spark, calibration_rows):
    texts, labels = made_up(400, 7)
    ids = spark.range(400).where(T.fold_of(F.col("id")) == T.CALIBRATION)
    for row in ids.collect():
        texts[row.id] += " qwyjibo" * labels[row.id]
    model = T.train(docs_table(spark, texts), labels_table(spark, labels), calibration_rows)
    only_there, nowhere = model.evidence.evidence(["qwyjibo", "qxyjibo"])
    assert only_there > 3 and only_there > nowhere + 3


def test_a_written_table_leaves_no_shuffle_files(spark):
    import os
    import time

    from quitanda.llm.common import written

    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    folders = [folder.toString() for folder in manager.localDirs()]

    def shuffled():
        found = (file for folder in folders for *_, files in os.walk(folder) for file in files)
        return {file for file in found if file.startswith("shuffle_")}

    before, frame = shuffled(), spark.range(5000).groupBy((F.col("id") % 1000).alias("k")).count()
    assert written(frame, "test").count() == 1000
    until = time.time() + 20
    while (left := {f for f in shuffled() - before if f.endswith(".data")}) and time.time() < until:
        time.sleep(0.2)
    assert len(left) <= 1  # of the count above


def test_the_label_filter_loses_no_labelled_text(spark):
    from quitanda.llm.common import likely_rows

    rows = spark.createDataFrame([(i, f"t{i}", "x") for i in range(3000)], "doc_id bigint, text string, place0 string")
    for step in (1, 7, 5000):
        keys = spark.createDataFrame([(i,) for i in range(0, 6000, step)], "doc_id bigint")
        found = likely_rows(rows, keys, "doc_id")
        assert found.columns == rows.columns
        left = {r.doc_id: r.text for r in found.collect()}
        assert set(range(0, 3000, step)) <= set(left)
        assert len(left) < 3000 // step + 100 and all(t == f"t{i}" for i, t in left.items())
    none = likely_rows(rows, spark.createDataFrame([], "doc_id bigint"), "doc_id")
    assert none.count() == 0 and likely_rows(rows.limit(0), rows.select("doc_id"), "doc_id").count() == 0
