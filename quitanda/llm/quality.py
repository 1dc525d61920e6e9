"""Quality rules as a short-circuit cascade, ordered by rejections per cost on a sample."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import map_rows, map_text

SYMBOLS = b"#*$%&|<>"
REPEAT_WINDOW = 5

# Rows looked at to order the rules. The order changes the cost of a run, never its result.
SAMPLED_ROWS = 2_000


class Document:
    """A text whose features are worked out when a rule first asks for them."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self._known: dict[str, int] = {}
        self._words: list[bytes] | None = None
        self._bytes: bytes | None = None

    @property
    def raw(self) -> bytes:
        if self._bytes is None:
            self._bytes = self.text.encode()
        return self._bytes

    @property
    def words(self) -> list[bytes]:
        """Runs of anything but the six ASCII white-space characters, as UTF-8."""
        if self._words is None:
            self._words = self.raw.split()
        return self._words

    def __getitem__(self, feature: str) -> int:
        if feature not in self._known:
            self._known[feature] = FEATURES[feature](self)
        return self._known[feature]


def _code_points(raw: bytes) -> int:
    return len(raw.decode())


def _dup_lines(doc: Document) -> int:
    lines = [line for line in doc.raw.split(b"\n") if line.strip()]
    return len(lines) - len(set(lines))


def repeated_words(words: Sequence[bytes], window: int = REPEAT_WINDOW) -> int:
    """Words that lie in a window of words found twice or more, the first one included.

    Windows are ranked by doubling, which compares them exactly in arrays of the text's length.
    """
    import numpy as np

    if len(words) <= window:
        return 0
    ids: dict[bytes, int] = {}
    rank = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    if len(ids) == len(words):
        return 0
    ranks = {1: rank}
    have = 1
    while have < window:
        more = max(n for n in ranks if n <= window - have)
        tail = ranks[more][have : len(words) - more + 1]
        pair = rank[: len(tail)] * (int(tail.max()) + 1) + tail
        rank = np.unique(pair, return_inverse=True)[1]
        have += more
        ranks[have] = rank
    twice = np.flatnonzero(np.bincount(rank)[rank] > 1)
    edges = np.zeros(len(words) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + window, -1)
    return int(np.count_nonzero(np.cumsum(edges)))


FEATURES: dict[str, Callable[[Document], int]] = {
    "n_words": lambda doc: len(doc.words),
    "word_chars": lambda doc: _code_points(b"".join(doc.words)),
    "n_symbols": lambda doc: len(doc.raw) - len(doc.raw.translate(None, SYMBOLS)),
    "n_dup_lines": _dup_lines,
    "n_repeat_words": lambda doc: repeated_words(doc.words),
    "n_exclamations": lambda doc: doc.raw.count(b"!"),
    "n_no_letter": lambda doc: sum(re.search(rb"[A-Za-z\x80-\xff]", w) is None for w in doc.words),
    "n_shouted": lambda doc: sum(re.search(rb"[A-Z]{2}", w) is not None for w in doc.words),
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Rejects a document for which ``rejects`` holds; ``features`` is all it may ask for."""

    name: str
    features: tuple[str, ...]
    rejects: Callable[[Document], bool]


BASE_RULES = (
    Rule("few_words", ("n_words",), lambda d: d["n_words"] < 10),
    Rule(
        "repeats",
        ("n_words", "n_repeat_words"),
        lambda d: 100 * d["n_repeat_words"] > 20 * d["n_words"],
    ),
)
# Shares of words, in percent.
RULES = BASE_RULES + (
    Rule("symbols", ("n_words", "n_symbols"), lambda d: 100 * d["n_symbols"] > 20 * d["n_words"]),
    Rule(
        "exclamations",
        ("n_words", "n_exclamations"),
        lambda d: 100 * d["n_exclamations"] > 30 * d["n_words"],
    ),
    Rule(
        "no_letters", ("n_words", "n_no_letter"), lambda d: 100 * d["n_no_letter"] > 30 * d["n_words"]
    ),
    Rule("shouting", ("n_words", "n_shouted"), lambda d: 100 * d["n_shouted"] > 50 * d["n_words"]),
    Rule(
        "word_length",
        ("n_words", "word_chars"),
        lambda d: not 2 * d["n_words"] <= d["word_chars"] <= 15 * d["n_words"],
    ),
)


def measure(rules: Sequence[Rule], texts: Sequence[str | None]) -> list[tuple[float, list[bool]]]:
    """For each rule its seconds alone over the texts, and which of them it rejects."""
    from time import perf_counter

    found = []
    for rule in rules:
        docs = [Document(text) for text in texts]
        began = perf_counter()
        rejected = [bool(rule.rejects(doc)) for doc in docs]
        found.append((perf_counter() - began, rejected))
    return found


def order_rules(rules: Sequence[Rule], sample: DataFrame, text: str = "text") -> list[Rule]:
    """Greedy order: the rule that rejects most of what is left, per second, goes next.

    The sample is measured in the tasks; a row of flags and times for each text comes back.
    What a rule costs is counted without features that the rules before it ask for as well.
    """

    def start():
        def row(body):
            timed = measure(rules, [body])
            return [([seconds for seconds, _ in timed], [r[0] for _, r in timed])]

        return row

    rows = map_rows(
        sample.select(F.col(text).alias("t")), start, "s array<double>, r array<boolean>"
    ).collect()
    if not rows:
        return list(rules)
    seconds = [sum(row.s[i] for row in rows) for i in range(len(rules))]
    open_rows, left, known, ordered = list(range(len(rows))), list(range(len(rules))), set(), []
    while left:

        def rate(i: int) -> float:
            needed = rules[i].features
            share = sum(f not in known for f in needed) / max(len(needed), 1)
            cost = max(seconds[i] * max(share, 0.1), 1e-9)
            return sum(rows[n].r[i] for n in open_rows) / cost

        best = max(left, key=lambda i: (rate(i), -seconds[i]))
        left.remove(best)
        ordered.append(rules[best])
        known.update(rules[best].features)
        open_rows = [n for n in open_rows if not rows[n].r[best]]
    return ordered


def bounded_sample(docs: DataFrame, rows: int = SAMPLED_ROWS) -> DataFrame:
    """About ``rows`` rows, ``2 * rows`` at most, from all of the input."""
    total = docs.count()
    share = min(1.0, 1.2 * rows / max(total, 1))
    return docs.sample(fraction=share, seed=11).limit(2 * rows)


def judge_quality(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    rules: Sequence[Rule] = RULES,
    report: Sequence[str] = (),
    ordered: bool = False,
    verdict: str = "kept",
) -> DataFrame:
    """The columns in ``keep``, the features in ``report`` and ``verdict``, per input row.

    A document is kept if no rule rejects it. Rules run in the order found by
    ``order_rules`` and stop at the first that rejects; with ``ordered`` in the order given.
    As the verdict is whether any rule rejects, it does not depend on that order.

    A null or empty text has no words, which ``few_words`` rejects. Repeated rows are judged
    each alone; columns not named in ``keep`` are neither read nor changed. No shuffle.
    """
    cascade = list(rules) if ordered else order_rules(rules, bounded_sample(docs), text)
    reported = tuple(report)

    def start():
        def row(body):
            doc = Document(body)
            passed = not any(rule.rejects(doc) for rule in cascade)
            return *(doc[feature] for feature in reported), passed

        return lambda texts: map(row, texts)

    fields = [(feature, "bigint") for feature in reported] + [(verdict, "boolean")]
    return map_text(docs, start, text, keep, fields)
