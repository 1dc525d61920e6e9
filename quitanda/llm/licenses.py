"""License scan by conditional compression: the template that explains a block best wins."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from difflib import SequenceMatcher

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import map_rows

# Notices by SPDX identifier.
TEMPLATES = {
    "MIT": "Released under the MIT License.",
    "MIT-0": "Released under the MIT No Attribution License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-2.0-only": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0-only": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-3.0-only": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0-only": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, v. 2.0.",
    "BSD-2-Clause": "Released under the BSD 2-Clause License.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "ISC": "Released under the ISC License.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-ND-4.0": "Licensed under CC BY-ND 4.0.",
    "CC-BY-NC-SA-4.0": "Licensed under CC BY-NC-SA 4.0.",
}

# A line is looked at if it has one of these; nothing without one can match a template.
_CUE = re.compile(r"licen[sc]|copyright|public domain|\bCC0\b|\bCC[ -]BY\b", re.IGNORECASE)
_WORD = re.compile(r"[^\W_]+(?:[.-][^\W_]+)*")

# Words of a block, in lengths of the longest notice.
BLOCK_NOTICES = 4

# Savings that differ by no more bytes explain a block equally well: sequences take whole bytes.
EQUAL_BYTES = 2

# Share of a template's words that may differ.
CHANGED_SHARE = 0.2


# Number of changes, first word, end, and the changes.
Match = tuple[int, int, int, list[str]]


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


class Reductions:
    """Sizes of blocks of words under zstandard, alone and with each template as raw dictionary."""

    def __init__(self, templates: Mapping[str, str]):
        import zstandard

        self._alone = zstandard.ZstdCompressor(level=19, write_content_size=False)
        self._given = {
            name: zstandard.ZstdCompressor(
                level=19,
                write_content_size=False,
                dict_data=zstandard.ZstdCompressionDict(
                    " ".join(words_of(text)).encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
                ),
            )
            for name, text in templates.items()
            if words_of(text)
        }

    def ranked(self, words: list[str]) -> list[tuple[int, float, str]]:
        """Bytes and share that each template saves of a block, the largest first."""
        raw = " ".join(words).encode()
        alone = len(self._alone.compress(raw))
        saved = [(alone - len(given.compress(raw)), name) for name, given in self._given.items()]
        saved.sort(key=lambda s: (-s[0], s[1]))
        return [(size, size / alone, name) for size, name in saved]


def differences(block: str, template: str) -> tuple[list[str], list[str]]:
    """Template words that the block lacks, and words it has between those it shares."""
    return _aligned(words_of(block), words_of(template))[:2]


def _aligned(have: list[str], want: list[str]) -> tuple[list[str], list[str], int, int]:
    """Missing and other words, and where the shared words begin and end in ``have``."""
    matches = SequenceMatcher(None, have, want, autojunk=False).get_matching_blocks()[:-1]
    matched = {m.b + i for m in matches for i in range(m.size)}
    missing = [word for i, word in enumerate(want) if i not in matched]
    extra = [
        word
        for before, after in zip(matches, matches[1:])
        for word in have[before.a + before.size : after.a]
    ]
    first, end = (matches[0].a, matches[-1].a + matches[-1].size) if matches else (0, 0)
    return missing, extra, first, end


class Matcher:
    """Places where the words of a text are those of a template but for CHANGED_SHARE of them."""

    def __init__(self, templates: Mapping[str, str]):
        self._words = {name: words_of(text) for name, text in templates.items()}
        self.slack = {name: int(CHANGED_SHARE * len(w)) for name, w in self._words.items()}
        self._starts = {name: set(w[: self.slack[name] + 1]) for name, w in self._words.items()}
        self.reach = max((len(w) + self.slack[n] for n, w in self._words.items()), default=0)

    def at(self, name: str, words: list[str], start: int, stop: int) -> Match | None:
        """The match of a template that begins at a word and has fewest changes, if any does."""
        if words[start] not in self._starts[name]:
            return None
        want, slack = self._words[name], self.slack[name]
        found = []
        for size in range(len(want) - slack, len(want) + slack + 1):
            missing, extra, first, end = _aligned(words[start : min(start + size, stop)], want)
            changed = len(missing) + len(extra)
            if end and not first and changed <= slack:
                changes = [f"-{w}" for w in missing] + [f"+{w}" for w in extra]
                found.append((changed, start, start + end, changes))
        return min(found, default=None)


class Explainer:
    """The notices of a run of words, by the templates that explain its blocks best."""

    def __init__(self, templates: Mapping[str, str]):
        self._reductions, self.matcher = Reductions(templates), Matcher(templates)

    def notices(
        self, words: list[str], start: int, stop: int, fits: Callable[[int, int], bool]
    ) -> Iterator[tuple[Match, str, float]]:
        """Confirmed matches, templates and reductions of blocks between two words, from left to right.

        Blocks overlap by the longest notice. One that begins in the overlap is left to the next
        block, which has all of it. ``fits`` says whether a match from one word to another counts.
        """
        reach = self.matcher.reach
        size = BLOCK_NOTICES * reach
        while start < stop:
            end = min(start + size, stop)
            last = end if end == stop else end - reach
            found = list(self._explained(words, start, end, lambda a, b: a < last and fits(a, b)))
            yield from found
            start = max([last, *(match[2] for match, _, _ in found)])

    def _explained(
        self, words: list[str], start: int, stop: int, fits: Callable[[int, int], bool]
    ) -> Iterator[tuple[Match, str, float]]:
        """Of a block, what its best template confirms, and the same of the words left and right
        of that, until nothing is confirmed of which a template saves anything."""
        if start >= stop:
            return
        for *_, name in self._reductions.ranked(words[start:stop]):
            claim = self._confirmed(name, words, start, stop, fits)
            if claim is None:
                continue
            # What is confirmed around the claim is a block of its own, without the words beside it,
            # whose sizes would drown what tells similar templates apart.
            slack = self.matcher.slack[name]
            low, high = max(start, claim[1] - slack), min(stop, claim[2] + slack)
            rivals = {name: claim}
            for *_, other in self._reductions.ranked(words[low:high]):
                if match := self._confirmed(other, words, low, high, fits):
                    rivals[other] = match
            low, high = min(m[1] for m in rivals.values()), max(m[2] for m in rivals.values())
            saved = {other: pair for *pair, other in self._reductions.ranked(words[low:high])}
            most = max(saved[other][0] for other in rivals)
            least = max(1, most - EQUAL_BYTES)
            if most < least:
                continue
            match, name = min((m, other) for other, m in rivals.items() if saved[other][0] >= least)
            share = saved[name][1]
            yield from self._explained(words, start, match[1], fits)
            yield match, name, share
            yield from self._explained(words, match[2], stop, fits)
            return

    def _confirmed(
        self, name: str, words: list[str], start: int, stop: int, fits: Callable[[int, int], bool]
    ) -> Match | None:
        """The match of a template in a block that has fewest changes, the first of these."""
        found = (self.matcher.at(name, words, place, stop) for place in range(start, stop))
        return min((m for m in found if m and fits(m[1], m[2])), default=None)


def scan_licenses(
    docs: DataFrame,
    templates: Mapping[str, str] = TEMPLATES,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """A row for each license notice: key, line, license, reduction, exact, changes.

    A notice is a run of words, over any line breaks, that touches a line with a cue. Blocks of
    words are cut around these lines. A block is compressed alone and with every template as
    dictionary, and the templates are ranked by what they save. They are confirmed in this order:
    a template's notice differs in at most ``CHANGED_SHARE`` of its words. All that are confirmed
    around its place are ranked once more by what they save of the words between them; the first
    one names the notice, of savings equal but for ``EQUAL_BYTES`` the one with the fewest
    differing words, then the first place and name. It has to save something. What is left on
    either side is ranked in the same way until nothing is confirmed.

    ``reduction`` is the share of the words around its place that the template saves; ``line`` is
    where the notice begins; ``changes`` lists the differing words, with ``-`` for missing and ``+``
    for other ones, and ``exact`` says there are none. A line with a cue that no notice touches has
    a row with null in ``license``.

    A text that is null, empty or without a cue has no row. Long texts and lines are read whole,
    in blocks that overlap by the longest notice. A template of a few letters, which saves
    nothing of itself, is never found. Repeated rows give repeated results; other columns are not
    read. An empty table gives no rows. No shuffle.
    """
    notices = dict(templates)

    def start():
        explainer = Explainer(notices)
        reach = explainer.matcher.reach

        def row(k, body):
            if not body or not _CUE.search(body):
                return []
            lines = body.split("\n")
            cues = [number for number, line in enumerate(lines) if _CUE.search(line)]
            words, of, begins = [], [], []
            for number, line in enumerate(lines):
                begins.append(len(words))
                words += words_of(line)
                of += [number] * (len(words) - len(of))
            begins.append(len(words))
            spans = []
            for cue in cues:
                low = max(0, begins[cue] - reach)
                high = min(len(words), begins[cue + 1] + reach)
                if spans and low <= spans[-1][1]:
                    spans[-1][1] = high
                else:
                    spans.append([low, high])
            cued = np.cumsum([0, *np.isin(of, cues)])
            rows, touched = [], set()
            for low, high in spans:
                for (changed, place, end, changes), name, saved in explainer.notices(
                    words, low, high, lambda a, b: cued[a] < cued[b]
                ):
                    touched.update(of[place:end])
                    rows.append((place, (k, of[place], name, saved, not changed, changes)))
            rows += [
                (begins[cue], (k, cue, None, None, False, [])) for cue in cues if cue not in touched
            ]
            return [found for _, found in sorted(rows, key=lambda pair: pair[0])]

        return row

    kind = dict(docs.dtypes)[key]
    found = map_rows(
        docs.select(F.col(key).alias("k"), F.col(text).alias("t")),
        start,
        f"k {kind}, line bigint, license string, reduction double, exact boolean, "
        "changes array<string>",
    )
    return found.withColumnRenamed("k", key)
