"""Periodic runs of words: recursive frequency splitting, then a lag scan of what is left.

A run of period q is three periods long or more, so each of its words occurs in it three times
or more. A word that a segment has less often lies in no run of it and splits it. What is
stable under this is scanned for lags at which words repeat.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import cmp_to_key

import numpy as np
from pyspark.sql import DataFrame

from quitanda.llm.common import map_text

MIN_LENGTH = 24
MIN_PERIODS = 3

# Characters of the texts that are scanned together.
_CHARACTERS = 1_000_000

Run = tuple[int, int, int]


def frequent_segments(
    words: np.ndarray,
    breaks: Sequence[int] = (),
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
) -> list[tuple[int, int]]:
    """Segments (start, end) in which every word occurs ``min_periods`` times or more.

    ``breaks`` are places before which a segment ends anyway. All segments of a round are split
    at once; one that stays whole is done, and pieces shorter than ``min_length`` are given up.
    """
    place = np.arange(len(words))
    segment = np.zeros(len(words), np.int64)
    segment[np.asarray(breaks, np.int64)] = 1
    segment = np.cumsum(segment)
    width = int(words.max()) + 1 if len(words) else 1
    done = []
    while len(place):
        lengths = np.bincount(segment)
        long = lengths[segment] >= min_length
        place, segment = place[long], segment[long]
        if not len(place):
            break
        _, which, counts = np.unique(
            segment * width + words[place], return_inverse=True, return_counts=True
        )
        rare = counts[which] < min_periods
        split = np.zeros(int(segment.max()) + 1, bool)
        split[segment[rare]] = True
        whole = ~split[segment]
        if whole.any():
            starts = np.flatnonzero(whole & np.r_[True, segment[1:] != segment[:-1]])
            sizes = np.bincount(segment[whole])[segment[starts]]
            done += [(int(s), int(s + n)) for s, n in zip(place[starts], sizes)]
        kept = ~whole & ~rare
        cut = np.cumsum(np.r_[True, (segment[1:] != segment[:-1]) | rare[:-1]])
        place, segment = place[kept], cut[kept]
        if len(segment):
            segment = np.cumsum(np.r_[0, segment[1:] != segment[:-1]])
    return sorted(done)


def lag_scan(
    words: np.ndarray, min_length: int = MIN_LENGTH, min_periods: int = MIN_PERIODS
) -> list[Run]:
    """All runs (start, length, period) of a segment, by start and then period.

    Lags are scanned in bands (k/2, k], k doubling. In a run with period q of a band, the first
    window of k words comes again q words later and not before, so the distance from each
    window to its next equal one gives the only lag of the band worth a look at that place.
    Windows are ranked by doubling; a segment of n words costs about n (log n)^2.
    """
    n = len(words)
    found: dict[tuple[int, int], int] = {}
    _, rank = np.unique(words, return_inverse=True)
    k, longest = 1, n // min_periods
    while k < 2 * longest and len(rank):
        order = np.argsort(rank, kind="stable")
        same = rank[order[1:]] == rank[order[:-1]]
        at, lag = order[:-1][same], (order[1:] - order[:-1])[same]
        inside = (lag <= min(k, longest)) & (2 * lag > k)
        for q in np.unique(lag[inside]).tolist():
            _runs_of_lag(words, q, np.sort(at[inside & (lag == q)]), found, min_length, min_periods)
        if 2 * k > n:
            break
        _, rank = np.unique(
            rank[: n - 2 * k + 1] * (int(rank.max()) + 1) + rank[k : n - k + 1],
            return_inverse=True,
        )
        k *= 2
    return sorted((start, length, q) for (start, length), q in found.items())


def _runs_of_lag(words, q, starts, found, min_length, min_periods) -> None:
    """Runs of lag q around the given places, each widened as far as words repeat."""
    least = max(min_length, min_periods * q) - q
    end = -1
    for i in starts.tolist():
        if i < end:
            continue
        first = _matching_before(words, i, q)
        end = _matching_after(words, i, q)
        if end - first >= least:
            # A run of a smaller period spans the same words and was found in its band.
            found.setdefault((first, end - first + q), q)


def _matching_before(words: np.ndarray, i: int, q: int, step: int = 64) -> int:
    """The first place from which on all words up to i are those q places later."""
    while i > 0:
        low = max(0, i - step)
        differ = np.flatnonzero(words[low:i] != words[low + q : i + q])
        if len(differ):
            return low + int(differ[-1]) + 1
        i, step = low, 2 * step
    return 0


def _matching_after(words: np.ndarray, i: int, q: int, step: int = 64) -> int:
    """The first place from i on whose word is not the one q places later."""
    last = len(words) - q
    while i < last:
        high = min(last, i + step)
        differ = np.flatnonzero(words[i:high] != words[i + q : high + q])
        if len(differ):
            return i + int(differ[0])
        i, step = high, 2 * step
    return last


def find_runs(
    words: np.ndarray,
    breaks: Sequence[int] = (),
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
) -> list[Run]:
    """All runs (start, length, period) of a sequence of word numbers, by start, then period."""
    runs = []
    for start, end in frequent_segments(words, breaks, min_length, min_periods):
        found = lag_scan(words[start:end], min_length, min_periods)
        runs += [(start + at, length, q) for at, length, q in found]
    return runs


def most_repeated(runs: Sequence[Run]) -> Run | None:
    """The run of greatest length / period; of equal ones the first, then the smallest period."""

    def order(a: Run, b: Run) -> int:
        return b[1] * a[2] - a[1] * b[2] or a[0] - b[0] or a[2] - b[2]

    return min(runs, key=cmp_to_key(order)) if runs else None


def collapsed(words: Sequence[bytes], runs: Sequence[Run]) -> list[bytes]:
    """The words without those of each run after its first period."""
    if not runs:
        return list(words)
    kept = np.ones(len(words), bool)
    for start, length, q in runs:
        kept[start + q : start + length] = False
    return [words[i] for i in np.flatnonzero(kept).tolist()]


def periodic_runs(
    docs: DataFrame,
    keep: Sequence[str] = ("doc_id",),
    text: str = "text",
    min_length: int = MIN_LENGTH,
    min_periods: int = MIN_PERIODS,
) -> DataFrame:
    """The columns in ``keep`` and, after them, runs, most_repeated and collapsed of each text.

    ``runs`` lists (start, length, period) by start and period: stretches of words with smallest
    period ``period``, at least ``min_length`` words and ``min_periods`` periods long, that no
    neighbouring word extends. Words are counted from 0. ``most_repeated`` is the run of greatest
    length / period (ties: smallest start, then period), null without a run. ``collapsed`` has the
    words joined by one space, without those of a run after its first period.

    A null or empty text has no runs and collapses to the empty text. Texts are scanned whole, in
    arrays of their own length, so a very long text costs little more per word. Each row is
    judged alone, so repeated rows get equal results; other columns are not read, whatever
    they are called. An empty table gives no rows.
    """
    if min_periods < 3:
        raise ValueError("min_periods must be 3 or more")

    def start():
        return lambda texts: [
            row for part in _parts(texts) for row in _judged(part, min_length, min_periods)
        ]

    run = "struct<start: bigint, length: bigint, period: bigint>"
    fields = [("runs", f"array<{run}>"), ("most_repeated", run), ("collapsed", "string")]
    return map_text(docs, start, text, keep, fields)


def _parts(texts: Sequence[str | None]) -> Iterator[list[str | None]]:
    """Texts in their order, with about ``_CHARACTERS`` at once or one longer text."""
    part, size = [], 0
    for body in texts:
        part.append(body)
        size += len(body or "")
        if size >= _CHARACTERS:
            yield part
            part, size = [], 0
    if part:
        yield part


def _judged(texts: Sequence[str | None], min_length: int, min_periods: int) -> list[tuple]:
    """Runs, the most repeated one and the collapsed text of each text.

    All texts are one sequence of word numbers, in which none reaches into the next.
    """
    numbers: dict[bytes, int] = {}
    bodies = [(body or "").encode().split() for body in texts]
    ids = [numbers.setdefault(word, len(numbers)) for words in bodies for word in words]
    ends = np.cumsum([len(words) for words in bodies])
    runs = find_runs(np.array(ids, np.int64), ends[ends < len(ids)], min_length, min_periods)
    owner = np.searchsorted(ends, [start for start, _, _ in runs], side="right")
    own: list[list[Run]] = [[] for _ in bodies]
    for i, (start, length, period) in zip(owner.tolist(), runs):
        own[i].append((start - int(ends[i]) + len(bodies[i]), length, period))
    return [
        (
            [_row(run) for run in found],
            _row(most_repeated(found)),
            b" ".join(collapsed(words, found)).decode(),
        )
        for words, found in zip(bodies, own)
    ]


def _row(run: Run | None) -> dict[str, int] | None:
    return None if run is None else dict(zip(("start", "length", "period"), run))
