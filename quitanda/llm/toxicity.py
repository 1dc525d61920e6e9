"""Toxicity by two class-conditional Kneser-Ney models over the characters of words.

A character is predicted from the four before it, back to the start of its word. Toxic and
ordinary texts have counts of their own at that order. What either has not seen, it takes
from one backoff model that both share, built from continuation counts of all training texts,
so rare expressions give no evidence by themselves.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quitanda.llm.common import discard, likely_rows, map_batches, release_shuffles, written

ORDER = 5
DISCOUNT = 0.75

# Distinct words after which a block of texts ends: what a task holds when it scores them.
BLOCK_WORDS = 200_000

# Labelled rows that the last step, from evidence to a probability, is fitted on at most.
CALIBRATION_ROWS = 20_000

HELD_OUT = 2
CALIBRATION = 3
THRESHOLD = 0.3

_LETTERS = re.compile(r"[^\W\d_]+")
_COUNTED_WORDS = 100_000
_WORDS_AT_ONCE = 5_000
_PAD, _END = 1, 2


def fold_of(key: Column) -> Column:
    return F.crc32(key.cast("string").cast("binary")) % 4


def words_in(text: str | None) -> list[str]:
    """Runs of letters, in lower case."""
    return _LETTERS.findall((text or "").lower())


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def grams_of(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of every character of every word: the word's index, and hashes of what ends there.

    Row k of the second array is of the k + 1 last characters, row k of the third of the k
    characters before this one. The end of a word counts as a character.
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    pad = ORDER - 1
    text = (chr(_PAD) * pad).join(f"{word}{chr(_END)}" for word in words)
    codes = np.frombuffer(f"{chr(_PAD) * pad}{text}".encode("utf-32-le"), np.uint32)
    codes = codes.astype(np.uint64)
    starts = np.cumsum(lengths + 1 + pad) - (lengths + 1 + pad) + pad
    owner = np.repeat(np.arange(len(words)), lengths + 1)
    offsets = np.arange(len(owner)) - np.repeat(np.cumsum(lengths + 1) - (lengths + 1), lengths + 1)
    at = starts[owner] + offsets
    step = np.uint64(0x9E3779B97F4A7C15)
    contexts = np.zeros((ORDER, len(at)), np.uint64)
    for k in range(1, ORDER):
        contexts[k] = _mixed((contexts[k - 1] + np.uint64(k)) * step + codes[at - k])
    grams = _mixed((contexts + np.uint64(77)) * step + codes[at])
    return owner, grams, contexts


def count_words(labelled: DataFrame) -> DataFrame:
    """Words of the rows (text, toxic, reserved) with their number in toxic and in ordinary texts.

    Words of reserved rows and of the others are counted apart.
    """

    def start():
        counts = {(label, kept): Counter() for label in (False, True) for kept in (False, True)}

        def flushed():
            rows = [
                (word, kept, counts[True, kept][word], counts[False, kept][word])
                for kept in (False, True)
                for word in {**counts[False, kept], **counts[True, kept]}
            ]
            for counter in counts.values():
                counter.clear()
            return rows

        def rows(texts, toxic, reserved):
            for text, label, kept in zip(texts, toxic, reserved):
                counts[bool(label), kept].update(words_in(text))
            return flushed() if sum(map(len, counts.values())) > _COUNTED_WORDS else []

        rows.rest = flushed
        return rows

    schema = "word string, reserved boolean, toxic bigint, ordinary bigint"
    return map_batches(labelled, start, schema).groupBy("word", "reserved").agg(
        F.sum("toxic").alias("toxic"), F.sum("ordinary").alias("ordinary")
    )


def count_grams(words: DataFrame) -> DataFrame:
    """Distinct expressions of ORDER characters with their numbers and the hashes below them."""
    hashes = [f"g{k}" for k in range(1, ORDER + 1)] + [f"c{k}" for k in range(1, ORDER + 1)]

    def start():
        def rows(word, toxic, ordinary):
            owner, grams, contexts = grams_of(word)
            _, first, which = np.unique(grams[-1], return_index=True, return_inverse=True)
            sums = [
                np.bincount(which, np.array(n, float)[owner]).astype(np.int64).tolist()
                for n in (toxic, ordinary)
            ]
            columns = [row[first].view(np.int64).tolist() for row in (*grams, *contexts)]
            return list(zip(*columns, *sums))

        return rows

    schema = ", ".join([f"{name} bigint" for name in (*hashes, "toxic", "ordinary")])
    return (
        map_batches(words.select("word", "toxic", "ordinary"), start, schema)
        .groupBy(f"g{ORDER}")
        .agg(
            *[F.first(name).alias(name) for name in hashes if name != f"g{ORDER}"],
            F.sum("toxic").alias("toxic"),
            F.sum("ordinary").alias("ordinary"),
        )
    )


def shared_backoff(grams: DataFrame) -> DataFrame:
    """Kneser-Ney probability of the last character after ORDER - 2 characters, for all classes.

    A shorter expression counts how many different characters stand before it, not how often
    it occurs. Columns: the hash of the shorter expression and p.
    """
    levels, below = [], grams
    for k in range(ORDER - 1, 0, -1):
        names = [f"{side}{n}" for n in range(1, k + 1) for side in "gc" if (side, n) != ("g", k)]
        below = below.groupBy(f"g{k}").agg(
            F.count(F.lit(1)).alias("seen"), *[F.first(name).alias(name) for name in names]
        )
        levels.append((k, below))
    shared = None
    for k, level in reversed(levels):
        after = Window.partitionBy(f"c{k}")
        total, kinds = F.sum("seen").over(after), F.count(F.lit(1)).over(after)
        level = level.withColumns({"total": total, "kinds": kinds})
        direct = F.greatest(F.col("seen") - DISCOUNT, F.lit(0.0)) / F.col("total")
        if shared is None:
            shared = level.select(f"g{k}", (F.col("seen") / F.col("total")).alias("p"))
            continue
        shared = level.join(shared, f"g{k - 1}").select(
            f"g{k}", (direct + DISCOUNT * F.col("kinds") / F.col("total") * F.col("p")).alias("p")
        )
    return shared


@dataclass(frozen=True)
class EvidenceModel:
    """Log-likelihood ratios as a whole table (gram, context, ratio, spare), looked up by shuffles.

    It has every counted expression; ``spare`` is the ratio of its context, for what comes next
    there unseen.
    """

    ratios: DataFrame

    def ratios_of(self, wanted: DataFrame) -> DataFrame:
        """Rows (block, gram, ratio) for all of (block, gram, context); without evidence 0.

        An expression lies with its context, so one shuffle by context finds both.
        """
        rows = self.ratios.unionByName(wanted, allowMissingColumns=True)
        before = Window.partitionBy("context")
        rows = rows.withColumn("spare", F.max("spare").over(before))
        same = Window.partitionBy("context", "gram")
        rows = rows.withColumn("ratio", F.max("ratio").over(same))
        ratio = F.coalesce("ratio", "spare", F.lit(0.0))
        return rows.where("block IS NOT NULL").select("block", "gram", ratio.alias("ratio"))

    def evidence(self, words: Sequence[str]) -> np.ndarray:
        """Toxic minus ordinary log-likelihood of each word, for a few words at the driver."""
        grams, contexts = distinct_grams(words)
        rows = [(0, *pair) for pair in zip(grams.tolist(), contexts.tolist())]
        spark = self.ratios.sparkSession
        wanted = spark.createDataFrame(rows, "block bigint, gram bigint, context bigint")
        found = self.ratios_of(wanted).orderBy("gram").collect()
        return evidence_of(words, [row.ratio for row in found])


def distinct_grams(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the distinct expressions of ORDER characters in words, and of their contexts."""
    grams, contexts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for at in range(0, len(words), _WORDS_AT_ONCE):
        _, found, before = grams_of(words[at : at + _WORDS_AT_ONCE])
        grams, first = np.unique(
            np.concatenate([grams, found[-1].view(np.int64)]), return_index=True
        )
        contexts = np.concatenate([contexts, before[-1].view(np.int64)])[first]
    return grams, contexts


def evidence_of(words: Sequence[str], ratios: Sequence[float]) -> np.ndarray:
    """Sums of the ratios of each word's expressions; ``ratios`` are in the order of their hashes."""
    owners, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for start in range(0, len(words), _WORDS_AT_ONCE):
        owner, grams, _ = grams_of(words[start : start + _WORDS_AT_ONCE])
        owners.append(owner + start)
        hashes.append(grams[-1].view(np.int64))
    _, which = np.unique(np.concatenate(hashes), return_inverse=True)
    values = np.array(ratios, float)[which]
    return np.bincount(np.concatenate(owners), values, len(words)).astype(float)


def train_evidence(labelled: DataFrame) -> EvidenceModel:
    """The two models from all rows (text, toxic), as ratios."""
    return evidence_from(count_words(labelled.select("text", "toxic", F.lit(False).alias("reserved"))))


def evidence_from(words: DataFrame) -> EvidenceModel:
    """The two models from rows (word, toxic, ordinary); a word may have several."""
    grams = written(count_grams(words), "toxicity-grams")
    context, below = f"c{ORDER}", f"g{ORDER - 1}"
    after = Window.partitionBy(context)
    rows = grams.join(shared_backoff(grams), below)
    logs, spare = [], []
    for name in ("toxic", "ordinary"):
        n, total = F.col(name), F.sum(name).over(after)
        kinds = F.count_if(F.col(name) > 0).over(after)
        left = F.when(total > 0, DISCOUNT * kinds / total).otherwise(1.0)
        direct = F.when(total > 0, F.greatest(n - DISCOUNT, F.lit(0.0)) / total).otherwise(0.0)
        logs.append(F.log(direct + left * F.col("p")))
        spare.append(F.log(left))
    rows = rows.select(
        F.col(f"g{ORDER}").alias("gram"),
        F.col(context).alias("context"),
        (logs[0] - logs[1]).alias("ratio"),
        (spare[0] - spare[1]).alias("spare"),
    )
    rows = written(rows, "toxicity-ratios")
    discard(grams)
    return EvidenceModel(rows)


def features_of(evidence: np.ndarray, lengths: np.ndarray) -> tuple[float, ...]:
    """What a text's words show: evidence per character, the strongest words, and the length."""
    if not len(evidence):
        return 0.0, 0.0, 0.0, 0.0, 0.0
    strongest = np.sort(evidence)[::-1][:3]
    strongest = np.concatenate([strongest, np.zeros(3 - len(strongest))])
    mean = float(evidence.sum() / (lengths.sum() + len(lengths)))
    clear = float(np.maximum(evidence - 4.0, 0.0).sum() / len(evidence))
    return mean * 100, *(float(x) for x in strongest[[0, 2]]), clear * 10, math.log1p(len(evidence))


N_FEATURES = 5


@dataclass(frozen=True)
class ToxicityModel:
    evidence: EvidenceModel | None
    weights: tuple[float, ...]

    def probability(self, features: Sequence[float]) -> float:
        value = self.weights[0] + sum(w * x for w, x in zip(self.weights[1:], features))
        return 1.0 / (1.0 + math.exp(-max(-30.0, min(30.0, value))))


def _packed_bag(ids: list[int]) -> bytes:
    """Sorted numbers by their differences, one byte plane after another, compressed."""
    steps = np.diff(np.array(ids, np.int64), prepend=0).astype("<u4")
    return zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _bag(packed: bytes) -> np.ndarray:
    planes = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.int64)


def _packed_words(words: Sequence[str]) -> bytes:
    return zlib.compress("\n".join(words).encode(), 1)


def _words(packed: bytes) -> list[str]:
    text = zlib.decompress(packed).decode()
    return text.split("\n") if text else []


# Rows of a block, in the order in which they are needed.
_RATIOS, _DICTIONARY, _TEXT = 0, 1, 2


def _blocks(docs: DataFrame, text: str, kept: Sequence[str]) -> DataFrame:
    """Texts as numbers of their words in blocks, and for each block a row with these words.

    A block ends with the task, or with the text that brings its distinct words above
    BLOCK_WORDS. Columns: block, kind, packed, and the kept ones as k0, k1, ...
    """
    kinds, largest = dict(docs.dtypes), BLOCK_WORDS

    def start():
        task, done, numbers = TaskContext.get().partitionId(), 0, {}

        def block():
            return (task << 32) + done

        def flushed():
            nonlocal done
            row = (block(), _DICTIONARY, _packed_words(list(numbers)), *[None] * len(kept))
            numbers.clear()
            done += 1
            return [row]

        def rows(texts, *columns):
            out = []
            for body, *values in zip(texts, *columns):
                bag = sorted(numbers.setdefault(word, len(numbers)) for word in words_in(body))
                out.append((block(), _TEXT, _packed_bag(bag), *values))
                if len(numbers) > largest:
                    out += flushed()
            return out

        rows.rest = flushed
        return rows

    columns = [docs[f"`{name}`"].alias(f"r{i}") for i, name in enumerate([text, *kept])]
    names = ["block bigint", "kind int", "packed binary"]
    names += [f"k{i} {kinds[name]}" for i, name in enumerate(kept)]
    return map_batches(docs.select(*columns), start, ", ".join(names))


def _with_features(
    docs: DataFrame,
    model: EvidenceModel,
    text: str,
    keep: Sequence[str],
    finish: Callable[[tuple[float, ...]], tuple],
    name: str,
    kind: str,
) -> tuple[DataFrame, list[DataFrame]]:
    """The columns in ``keep`` and what ``finish`` makes of a text's features, per input row; and
    the written tables that these are read from.

    The distinct expressions of each block are looked up in the model's table. What is found is
    written, so that nothing of the search is left on the disks when it meets the block's texts,
    which are kept and shuffled as word numbers only.
    """
    kept = list(keep)
    blocks = written(_blocks(docs, text, kept), "toxicity-blocks")

    def expressions():
        def rows(block, packed):
            return [(b, *distinct_grams(_words(p))) for b, p in zip(block, packed)]

        return rows

    dictionaries = blocks.where(F.col("kind") == _DICTIONARY).select("block", "packed")
    wanted = map_batches(
        dictionaries, expressions, "block bigint, grams array<bigint>, contexts array<bigint>"
    ).select("block", F.inline(F.arrays_zip("grams", "contexts")).alias("gram", "context"))
    found = model.ratios_of(wanted).groupBy("block")
    found = found.agg(F.sort_array(F.collect_list(F.struct("gram", "ratio"))).alias("found"))
    found = found.select(
        "block", F.lit(_RATIOS).alias("kind"), F.col("found.ratio").alias("ratios")
    )
    found = written(found, "toxicity-found")
    together = found.unionByName(blocks, allowMissingColumns=True)
    columns = ["block", "kind", "packed", "ratios", *[f"k{i}" for i in range(len(kept))]]
    together = together.select(*columns).repartition("block").sortWithinPartitions("block", "kind")

    def start():
        at, known, evidence, lengths = None, [], np.zeros(0), np.zeros(0, np.int64)

        def rows(block, kind, packed, ratios, *columns):
            nonlocal at, known, evidence, lengths
            out = []
            for b, k, p, r, *values in zip(block, kind, packed, ratios, *columns):
                if b != at:
                    at, known = b, []
                if k == _RATIOS:
                    known = r
                elif k == _DICTIONARY:
                    words = _words(p)
                    evidence = evidence_of(words, known)
                    lengths = np.fromiter(map(len, words), np.int64, len(words))
                else:
                    bag = _bag(p)
                    out.append((*values, *finish(features_of(evidence[bag], lengths[bag]))))
            return out

        return rows

    kinds = dict(docs.dtypes)
    names = [f"k{i} {kinds[column]}" for i, column in enumerate(kept)]
    mapped = map_batches(together, start, ", ".join([*names, f"n0 {kind}"]))
    return mapped.toDF(*kept, name), [blocks, found]


def fit_logistic(rows: np.ndarray, labels: np.ndarray, steps: int = 60) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge; an empty class gives its share."""
    if len(rows) == 0 or labels.min() == labels.max():
        share = (labels.sum() + 0.5) / (len(labels) + 1) if len(rows) else 0.01
        return math.log(share / (1 - share)), *[0.0] * N_FEATURES
    center, scale = rows.mean(0), np.maximum(rows.std(0), 1e-6)
    x = np.c_[np.ones(len(rows)), (rows - center) / scale]
    w = np.zeros(x.shape[1])
    ridge = np.diag([1e-3] + [1.0] * (x.shape[1] - 1))
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            x.T @ (x * (p * (1 - p))[:, None]) + ridge, x.T @ (labels - p) - ridge @ w
        )
        w = w + np.clip(step, -3, 3)
    slopes = w[1:] / scale
    return float(w[0] - slopes @ center), *map(float, slopes)


def train(
    docs: DataFrame, labels: DataFrame, calibration_rows: int = CALIBRATION_ROWS
) -> ToxicityModel:
    """Models from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic).

    Rows of the held-out fold are never used; the final models count all other labelled texts.
    The last step is fitted on at most ``calibration_rows`` rows of one fold, with models
    that count all but these rows. Labels of null, and of documents that are not there, are
    left out; of several labels for a document the highest counts.
    """
    folded = labels.where(F.col("toxic").isNotNull()).groupBy("doc_id")
    folded = folded.agg(F.max("toxic").alias("toxic"))
    fold = fold_of(F.col("doc_id"))
    texts = docs.select("doc_id", "text")

    # At most ``calibration_rows`` labels, so the texts need not move for them.
    few = folded.where(fold == CALIBRATION).orderBy(F.xxhash64("doc_id"), "doc_id")
    few = docs.sparkSession.createDataFrame(few.limit(calibration_rows).collect(), folded.schema)
    reserved = few.select("doc_id", F.lit(True).alias("reserved"))
    # Joined in the same way at every size: texts are shuffled once and not kept.
    wanted = folded.where(fold != HELD_OUT)
    counted = likely_rows(texts.where(fold != HELD_OUT), wanted, "doc_id")
    counted = counted.join(wanted.hint("merge"), "doc_id")
    counted = counted.join(F.broadcast(reserved), "doc_id", "left")
    words = written(
        count_words(
            counted.select("text", "toxic", F.coalesce("reserved", F.lit(False)).alias("reserved"))
        ),
        "toxicity-words",
    )
    calibrating = texts.where(fold == CALIBRATION).join(F.broadcast(few), "doc_id")
    partial = evidence_from(words.where(~F.col("reserved")))
    sample, tables = _with_features(
        calibrating,
        partial,
        "text",
        ["toxic"],
        lambda x: (list(x),),
        "x",
        "array<double>",
    )
    sample = sample.limit(2 * calibration_rows).collect()
    discard(*tables, partial.ratios)
    rows = np.array([row.x for row in sample], float).reshape(-1, N_FEATURES)
    weights = fit_logistic(rows, np.array([row.toxic > 0 for row in sample], float))
    evidence = evidence_from(words)
    discard(words)
    return ToxicityModel(evidence, weights)


def score(
    docs: DataFrame,
    model: ToxicityModel,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    name: str = "score",
) -> DataFrame:
    """The columns in ``keep`` and the score ``name`` (0 to 1, higher: likelier toxic), per input row.

    A null or empty text has no words and gets the score of no evidence. Repeated rows get
    equal scores; other columns are not read. The model is shuffled with the distinct
    expressions of the texts, whatever its size; texts are shuffled as word numbers.
    """
    # What training shuffled is in the model's tables by now.
    release_shuffles(docs.sparkSession)
    weigher = ToxicityModel(None, model.weights)
    scored, _ = _with_features(
        docs, model.evidence, text, keep, lambda x: (weigher.probability(x),), name, "double"
    )
    return scored
