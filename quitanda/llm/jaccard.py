"""Documents linked by the Jaccard similarity of their word shingles.

Texts with one set of shingles are one class. Classes that may be similar meet in an inverted
index of their prefixes: a class's shingles in the order of their hashes. The prefixes are
extended until similar classes share a number of shingles in them that grows with their size,
two at least. Frequent shingles, which would bring everything together, count as shared there; a
class that shares fewer of its prefix than it must is similar to none and leaves. Of the sets
that are left the shingles are counted one by one, and their plain prefixes indexed again in the
exact order, rare ones first: a rare shingle by itself, frequent ones by combinations of two.
This brings next to nothing together but what is similar; that is verified on the whole sets. Any
one order of the shingles finds every link, so which are taken for frequent changes the work and
not the result. They are counted over all documents, in the pass that makes the prefixes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from quitanda.llm.common import discard, map_batches, map_rows, release_shuffles, written
from quitanda.llm.components import components

# A shingle is frequent if it makes up this share of all shingles.
FREQUENT_SHARE = 2.0**-16

# Hashes that are counted at once, and the share of its shingles by which a task's counts are too low
# at most; adding them up misses as much again. So every frequent shingle is found, and none of less
# than half the share is taken.
_SUMMARY = 1 << 18
_MISSED_SHIFT = 18

# Summaries of tasks that are added up at once.
_SUMMARIES = 16

# Rows of the first pass: a document, and what a task has counted.
_DOCUMENT, _COUNTED = 0, 1

# Frequent shingles of larger sets are indexed alone: their combinations would outgrow them.
COMBINED_SIZE = 256

# What is verified together by one task: documents, and shingles in their sets.
BLOCK_ROWS = 1_000
BLOCK_SHINGLES = 2_000_000

# Blocks of a family up to which all of them meet; more than that go by index entry.
FAMILY_PARTS = 16

# Bits by which tasks know the classes to verify: 16 for each, up to this many.
FILTER_BITS = 1 << 27

_CACHED_WORDS = 300_000
_CACHED_CLASSES = 500_000
_COLUMNS = 4_096


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    value = (value ^ (value >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return value ^ (value >> np.uint64(31))


def _joined(columns: list[np.ndarray]) -> np.ndarray:
    """One 64-bit hash for each row of hashes."""
    found = np.full(len(columns[0]), len(columns), np.uint64)
    for column in columns:
        found = _mixed(found * np.uint64(0x9E3779B97F4A7C15) + column)
    return found


class Shingler:
    """Sets of word shingles as sorted 64-bit hashes."""

    def __init__(self, width: int):
        self.width = width
        self._words: dict[bytes, int] = {}

    def __call__(self, text: str | None) -> np.ndarray:
        """A-Z in lower case; with fewer words than the width, all of them are the one shingle."""
        from xxhash import xxh64_intdigest

        words = (text or "").encode().lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        known = self._words
        if len(known) > _CACHED_WORDS:
            known.clear()
        for word in set(words):
            if word not in known:
                known[word] = xxh64_intdigest(word)
        hashes = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        size = min(self.width, len(words))
        last = len(words) - size + 1
        return np.unique(_joined([hashes[i : i + last] for i in range(size)]))


def class_of(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


class Summary:
    """The most frequent hashes of a stream with too low counts, by 1 / _SUMMARY of it at most."""

    def __init__(self):
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.total, self.missed = 0, 0
        self._waiting: list[np.ndarray] = []
        self._size = 0

    def add(self, hashes: np.ndarray) -> None:
        self._waiting.append(hashes)
        self._size += len(hashes)
        self.total += len(hashes)
        if self._size > 1 << 20:
            self.merge()

    def merge(self) -> None:
        waiting = np.concatenate([*self._waiting, self.hashes[:0]])
        hashes, counts = np.unique(waiting, return_counts=True)
        self._waiting, self._size = [], 0
        self._join(hashes, counts)

    def add_summary(self, total: int, missed: int, hashes: np.ndarray, counts: np.ndarray) -> None:
        """Take in what another summary has counted."""
        self.total += total
        self.missed += missed
        self._join(hashes, counts)

    def _join(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        both = np.concatenate([self.hashes, hashes])
        order = np.argsort(both, kind="stable")
        both, counts = both[order], np.concatenate([self.counts, counts])[order]
        first = np.flatnonzero(np.diff(both, prepend=~both[:1]))
        self.hashes = both[first]
        self.counts = np.add.reduceat(counts, first) if len(first) else counts
        if len(self.counts) > _SUMMARY:
            self._lower(int(np.partition(self.counts, -_SUMMARY - 1)[-_SUMMARY - 1]))

    def _lower(self, by: int) -> None:
        self.missed += by
        kept = self.counts > by
        self.hashes, self.counts = self.hashes[kept], self.counts[kept] - by

    def shorten(self, shift: int) -> None:
        """Leave out what is rare, so that no count is too low by more than 2 ^ -shift of all."""
        self.merge()
        self._lower(max(0, (self.total >> shift) - self.missed))


def number_of(cls: bytes) -> int:
    """A class as a signed 64-bit number, which its index entries carry."""
    return int.from_bytes(cls[:8], "little", signed=True)


def least_overlap(n: int, num: int, den: int) -> int:
    """Shingles that a set of ``n`` has in common with any set it is linked to, at least."""
    return -(-n * num // den)


def shared_in_prefix(n: int, num: int, den: int) -> int:
    """Shingles of its extended prefix that a set of ``n`` is made to share: as many as the plain one."""
    overlap = least_overlap(n, num, den)
    return min(overlap, max(2, n - overlap + 1))


def signatures(shingles: np.ndarray, num: int, den: int) -> tuple[np.ndarray, int]:
    """A set's extended prefix in the order of hashes, and how many of it the set must share.

    Of two similar sets the one whose prefix ends first has all of its share within the other's
    prefix, so both have in common the share of the smaller set, which has ``least_overlap``
    shingles or more.
    """
    n = len(shingles)
    overlap = least_overlap(n, num, den)
    prefix = n - overlap + shared_in_prefix(n, num, den)
    return shingles[:prefix], shared_in_prefix(overlap, num, den)


def members_and_prefixes(
    docs: DataFrame, width: int, num: int, den: int, key: str, text: str
) -> DataFrame:
    """A row (k, n, cls, id, need, sigs) for each document: its set's size and class, the
    shingles of its prefix and how many of them it must share. ``sigs`` is null for a class
    that the task has lately seen, so copies add little.

    ``part`` tells these rows from one that follows them with the task's counts of the shingles of
    all sets it has seen: its number (need), the shingles counted (n), by how much a
    count may be too low (id), and shingles (sigs) with their ``counts``.
    """
    kind = dict(docs.dtypes)[key]

    def start():
        task = TaskContext.get().partitionId()
        shingler, seen, summary = Shingler(width), set(), Summary()

        def rows(keys, texts):
            found = []
            for k, body in zip(keys, texts):
                shingles = shingler(body)
                cls = class_of(shingles)
                if cls is None or cls in seen:
                    found.append((k, len(shingles), cls, None, None, None, None, _DOCUMENT))
                    continue
                if len(seen) > _CACHED_CLASSES:
                    seen.clear()
                seen.add(cls)
                summary.add(shingles)
                sigs, need = signatures(shingles, num, den)
                sigs = sigs.view(np.int64)
                found.append((k, len(shingles), cls, number_of(cls), need, sigs, None, _DOCUMENT))
            return found

        def rest():
            summary.shorten(_MISSED_SHIFT)
            sigs, counts = summary.hashes.view(np.int64), summary.counts
            row = summary.total, None, summary.missed, task, sigs, counts, _COUNTED
            return [(None, *row)]

        rows.rest = rest
        return rows

    return map_batches(
        docs.select(F.col(key).alias("k"), F.col(text).alias("t")),
        start,
        f"k {kind}, n bigint, cls binary, id bigint, need int, sigs array<bigint>, counts array<bigint>, "
        "part int",
    )


def _added_up(summaries: DataFrame) -> DataFrame:
    """One summary for each ``slot`` of rows (slot, total, missed, sigs, counts)."""

    def add(key, rows):
        import pandas as pd

        summary = Summary()
        for total, missed, sigs, counts in zip(
            rows["total"], rows["missed"], rows["sigs"], rows["counts"]
        ):
            hashes = np.asarray(sigs, np.int64).view(np.uint64)
            summary.add_summary(int(total), int(missed), hashes, np.asarray(counts, np.int64))
        return pd.DataFrame(
            {
                "slot": [key[0]],
                "total": [summary.total],
                "missed": [summary.missed],
                "sigs": [summary.hashes.view(np.int64)],
                "counts": [summary.counts],
            }
        )

    return summaries.groupBy("slot").applyInPandas(add, summaries.schema)


def frequent_shingles(found: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles by hash, sorted, and the rank of each, rarest first.

    They come from the counts among ``members_and_prefixes``, which all tasks made of all sets, and
    decide only the order in which shingles are indexed. A row is what one task has counted; a few
    at a time are added up until one is left, which is no larger than each of them may be.
    """
    counted = found.where(F.col("part") == _COUNTED).select(
        F.col("need").cast("bigint").alias("slot"),
        F.col("n").alias("total"),
        F.col("id").alias("missed"),
        "sigs",
        "counts",
    )
    last, tables = counted.agg(F.max("slot")).first()[0], []
    while last:
        slots = counted.withColumn("slot", F.expr(f"slot div {_SUMMARIES}"))
        counted = written(_added_up(slots), "jaccard-counts")
        tables.append(counted)
        last //= _SUMMARIES
    row = counted.first()
    discard(*tables)
    if row is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    hashes, often = np.array(row.sigs, np.int64).view(np.uint64), np.array(row.counts, np.int64)
    kept = often >= max(2, int(row.total * FREQUENT_SHARE) + 1 - row.missed)
    hashes, often = hashes[kept], often[kept]
    by_hash = np.argsort(hashes)
    hashes, often = hashes[by_hash], often[by_hash]
    order = np.empty(len(hashes), np.int64)
    order[np.lexsort((hashes, often))] = np.arange(len(hashes))
    return hashes, order


def _in_several(entries: DataFrame) -> DataFrame:
    """Index entries whose shingles at least two classes have."""
    spans = entries.groupBy("sig").agg(F.min("cls").alias("low"), F.max("cls").alias("high"))
    return entries.join(spans.where("low <> high").select("sig"), "sig")


def candidate_classes(prefixes: DataFrame, frequent: np.ndarray) -> DataFrame:
    """Classes (id) that share enough of their prefix with others to be similar to one.

    Most shingles are in one class only and go in the one shuffle by shingle. Frequent ones count
    as shared without being looked up, and are dealt out by class.
    """
    known = prefixes.sparkSession.createDataFrame(
        [(value,) for value in frequent.view(np.int64).tolist()], "sig bigint"
    ).withColumn("often", F.lit(True))
    entries = prefixes.select(F.explode("sigs").alias("sig"), "id", "need")
    entries = entries.join(F.broadcast(known), "sig", "left")
    spread = F.when(F.col("often"), F.col("id")).otherwise(F.lit(0))
    same = Window.partitionBy("sig", "spread")
    several = F.col("often").isNotNull() | (F.min("id").over(same) != F.max("id").over(same))
    shared = entries.withColumn("spread", spread).withColumn("several", several).where("several")
    return (
        shared.groupBy("id")
        .agg(F.count_distinct("sig").alias("shares"), F.first("need").alias("need"))
        .where("shares >= need")
        .select("id")
    )


def exact_entries(
    sets: DataFrame, frequent: tuple[np.ndarray, np.ndarray], num: int, den: int
) -> DataFrame:
    """Index entries (sig, cls) of plain prefixes, which share two shingles if sets are similar.

    Shingles are ordered by the number of ``sets`` that have them, so those of one set alone
    come first and need no entry. Frequent ones keep their order after all others and are not
    counted again.
    """
    shared = sets.sparkSession.sparkContext.broadcast(frequent)

    def start_tokens():
        hashes, order = shared.value

        def row(cls, n, raw):
            shingles = np.frombuffer(raw, np.uint64)
            at = np.searchsorted(hashes, shingles)
            at[at == len(hashes)] = 0
            often = hashes[at] == shingles if len(hashes) else np.zeros(n, bool)
            place = np.where(often, order[at] + 1, 0) if len(hashes) else np.zeros(n, np.int64)
            return [(cls, n, shingles.view(np.int64), place)]

        return row

    tokens = map_rows(
        sets.select("cls", "n", "shingles"),
        start_tokens,
        "cls binary, n bigint, token array<bigint>, place array<bigint>",
    )
    tokens = tokens.select("cls", "n", F.inline(F.arrays_zip("token", "place")))
    spread = F.when(F.col("place") == 0, F.lit(0)).otherwise(F.xxhash64("cls"))
    tokens = tokens.withColumn("spread", spread).withColumn(
        "sets", F.count(F.lit(1)).over(Window.partitionBy("token", "spread"))
    )
    ordered = F.sort_array(F.collect_list(F.struct("place", "sets", "token")))
    listed = (
        tokens.where("place > 0 or sets > 1")
        .groupBy("cls", "n")
        .agg(ordered.alias("o"))
        .select("cls", "n", *[F.col(f"o.{name}").alias(name) for name in ("token", "place")])
    )

    def start_entries():
        def row(cls, n, token, place):
            overlap = least_overlap(n, num, den)
            prefix = n - overlap + min(2, overlap) - (n - len(token))
            if prefix <= 0:
                return []
            token = np.array(token[:prefix], np.int64).view(np.uint64)
            often = np.array(place[:prefix], np.int64) > 0
            found = [token[~often], *_frequent_entries(token[often], n, num, den)]
            return [(np.concatenate(found).view(np.int64), cls)]

        return row

    entries = map_rows(listed, start_entries, "sigs array<bigint>, cls binary")
    return entries.select(F.explode("sigs").alias("sig"), "cls")


def _frequent_entries(common: np.ndarray, n: int, num: int, den: int) -> list[np.ndarray]:
    """Frequent shingles of a prefix as combinations of two; of a larger set one by one.

    A set of a size that may be linked with sets of both kinds has both kinds of entries.
    """
    found = [common] if n > COMBINED_SIZE * num // den else []
    if n <= COMBINED_SIZE and len(common) > 1:
        left, right = np.array(list(combinations(range(len(common)), 2))).T
        found.append(_joined([common[left], common[right]]))
    return found


def _filter_places(number: int, bits: int) -> list[int]:
    return [(number >> shift) & (bits - 1) for shift in (0, 18, 36)]


def class_filter(classes: DataFrame) -> np.ndarray:
    """A Bloom filter of classes (id), sized by their number up to ``FILTER_BITS``."""
    bits = min(FILTER_BITS, 1 << max(10, (16 * classes.count()).bit_length()))
    places = [F.expr(f"shiftright(id, {shift}) & {bits - 1}L") for shift in (0, 18, 36)]
    bit = classes.select(F.explode(F.array(*places)).alias("bit"))
    one = F.expr("shiftleft(1L, cast(bit % 64 as int))")
    words = bit.groupBy(F.expr("bit div 64").alias("word")).agg(F.bit_or(one).alias("bits"))
    found = words.toArrow()
    table = np.zeros(bits // 64, np.int64)
    table[found["word"].to_numpy()] = found["bits"].to_numpy()
    return table


def class_sets(docs: DataFrame, classes: DataFrame, width: int, text: str) -> DataFrame:
    """Rows (cls, n, shingles) for the given classes (id), read from the texts where they lie.

    The tasks know the classes by a filter, which lets a few others through; these do no harm,
    as all sets are verified. One row of each class stays.
    """
    shared = docs.sparkSession.sparkContext.broadcast(class_filter(classes))

    def start():
        shingler, seen, table = Shingler(width), set(), shared.value.view(np.uint64)
        bits = 64 * len(table)

        def wanted(cls):
            places = _filter_places(number_of(cls), bits)
            return all(int(table[bit >> 6]) >> (bit & 63) & 1 for bit in places)

        def rows(texts):
            found = []
            for body in texts:
                shingles = shingler(body)
                cls = class_of(shingles)
                if cls is None or cls in seen or not wanted(cls):
                    continue
                if len(seen) > _CACHED_CLASSES:
                    seen.clear()
                seen.add(cls)
                found.append((cls, len(shingles), shingles.tobytes()))
            return found

        return rows

    sets = map_batches(
        docs.select(F.col(text).alias("t")), start, "cls binary, n bigint, shingles binary"
    )
    return sets.dropDuplicates(["cls"])


def _matrix(sets: list[np.ndarray], tokens: np.ndarray) -> np.ndarray:
    found = np.zeros((len(sets), len(tokens)), np.float32)
    for row, shingles in zip(found, sets):
        at = np.searchsorted(tokens, shingles)
        at[at == len(tokens)] = 0
        row[at[tokens[at] == shingles]] = 1
    return found


def spanning_links(
    classes: list[bytes], sets: list[np.ndarray], split: int, num: int, den: int
) -> Iterator[tuple[bytes, bytes]]:
    """Links that connect what all links between two sides connect.

    The first ``split`` sets are one side and the rest the other; with ``split`` 0 all are
    compared with all. The sizes of intersections come from a product of incidence matrices
    over the shingles that two sets or more have, some thousands at a time.
    """
    sizes = np.array([len(s) for s in sets], np.float64)
    left, right = (slice(0, split), slice(split, None)) if split else (slice(None), slice(None))
    tokens, counts = np.unique(np.concatenate(sets), return_counts=True)
    tokens = tokens[counts > 1]
    shared = np.zeros((len(sizes[left]), len(sizes[right])), np.float64)
    for start in range(0, len(tokens), _COLUMNS):
        matrix = _matrix(sets, tokens[start : start + _COLUMNS])
        shared += matrix[left] @ matrix[right].T
    unions = sizes[left][:, None] + sizes[right][None, :] - shared
    linked = den * shared >= num * unions
    linked = linked if split else np.triu(linked, 1)
    parents = list(range(len(sets)))

    def root(i: int) -> int:
        while parents[i] != i:
            parents[i] = parents[parents[i]]
            i = parents[i]
        return i

    for i, j in np.argwhere(linked):
        a, b = root(int(i)), root(int(j) + split)
        if a != b:
            parents[max(a, b)] = min(a, b)
            yield classes[int(i)], classes[int(j) + split]


def verified(blocks: DataFrame, num: int, den: int) -> DataFrame:
    """Links (a, b) within groups (block) of rows (side, cls, shingles); side 0 meets side 1."""

    def link(block):
        import pandas as pd

        block = block.sort_values("side", kind="stable")
        sets = [np.frombuffer(raw, np.uint64) for raw in block["shingles"]]
        split = int((block["side"] == 0).sum()) % len(block)
        links = list(spanning_links(block["cls"].tolist(), sets, split, num, den))
        return pd.DataFrame(links, columns=["a", "b"])

    return blocks.groupBy("block").applyInPandas(link, "a binary, b binary")


def candidate_blocks(shared: DataFrame, sets: DataFrame) -> DataFrame:
    """Groups to verify, from index entries (sig, cls) and the sets of their classes.

    Classes that index entries connect are a family. A family small enough is one group; a
    larger one is dealt into blocks, each block with itself and with every other one. Beyond
    ``FAMILY_PARTS`` blocks each index entry has groups of its own, again in blocks where many
    classes have it. Every two classes with an entry in common meet in some group, and no group
    is larger than two blocks.
    """
    centers = shared.groupBy("sig").agg(F.min("cls").alias("b"))
    roots = components(shared.join(centers, "sig").select(F.col("cls").alias("a"), "b"))
    sizes = sets.select("cls", "n").join(roots, F.col("cls") == F.col("node"), "left")
    sizes = sizes.select("cls", "n", F.coalesce("root", "cls").alias("family"))
    sizes = written(sizes, "families")
    families = sizes.groupBy("family").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"))
    halves = F.greatest(F.col("rows") / (BLOCK_ROWS // 2), F.col("n") / (BLOCK_SHINGLES // 2))
    parts = F.when(halves <= 2, F.lit(1)).otherwise(F.ceil(halves)).cast("int")
    families = families.where("rows > 1").select("family", parts.alias("parts"))
    sizes = written(sizes.join(families, "family"), "families")

    blocked = sizes.where(F.col("parts") <= FAMILY_PARTS)
    blocked = blocked.select(F.base64("family").alias("key"), "cls", "parts")
    large = sizes.where(F.col("parts") > FAMILY_PARTS).select("cls", "n")
    entries = shared.join(large, "cls").select(F.col("sig").cast("string").alias("key"), "cls", "n")
    entry_parts = entries.groupBy("key").agg(
        F.ceil(
            F.greatest(
                F.count(F.lit(1)) / (BLOCK_ROWS // 2), F.sum("n") / (BLOCK_SHINGLES // 2), F.lit(1.0)
            )
        )
        .cast("int")
        .alias("parts")
    )
    entries = entries.join(entry_parts, "key").select("key", "cls", "parts")

    part = F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    pairs = blocked.union(entries).select("key", "cls", part.alias("part"), other.alias("other"))
    pairs = pairs.select(
        F.concat_ws("-", "key", F.least("part", "other"), F.greatest("part", "other")).alias("block"),
        (F.col("part") > F.col("other")).cast("int").alias("side"),
        "cls",
    )
    return pairs.join(sets.select("cls", "shingles"), "cls")


def jaccard_components(
    docs: DataFrame,
    width: int = 5,
    num: int = 80,
    den: int = 100,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """key, n_shingles and component_id of every document.

    Documents are linked when ``den`` times the size of the intersection of their shingle
    sets is at least ``num`` times that of the union; ``component_id`` is the smallest key
    that links reach, the document's own included. Shingles are told apart by 64-bit hashes.

    A null text, or one without words, has no shingles and is linked with nothing, also not
    with another such text. Very long texts are shingled whole. Rows with the same key are
    linked each by its own text; of equal smallest keys either names the component, which is
    the same. An empty table gives no rows. Other columns are not read, whatever their names.
    Copies meet as one class, so a group of them costs no pairs.
    """
    spark = docs.sparkSession
    found = members_and_prefixes(docs, width, num, den, key, text)
    found = written(found, "jaccard-prefixes")
    frequent = frequent_shingles(found)
    prefixes = found.where((F.col("part") == _DOCUMENT) & F.col("sigs").isNotNull())
    classes = written(candidate_classes(prefixes, frequent[0]), "jaccard-candidates")
    members = found.where(F.col("part") == _DOCUMENT).select(F.col("k").alias(key), "n", "cls")
    members = written(members, "jaccard-members")
    discard(found)
    release_shuffles(spark)
    sets = written(class_sets(docs, classes, width, text), "jaccard-sets")
    discard(classes)
    release_shuffles(spark)
    entries = written(exact_entries(sets, frequent, num, den), "jaccard-entries")
    shared = written(_in_several(entries), "jaccard-shared")
    discard(entries)
    release_shuffles(spark)
    links = written(verified(candidate_blocks(shared, sets), num, den), "jaccard-links")
    discard(shared, sets)
    release_shuffles(spark)
    return _labelled(members, components(links), key)


def _labelled(members: DataFrame, roots: DataFrame, key: str) -> DataFrame:
    """Members with the smallest key of their component."""
    classes = members.where(F.col("cls").isNotNull()).groupBy("cls").agg(F.min(key).alias("least"))
    classes = classes.join(roots, classes.cls == roots.node, "left").select(
        "cls", "least", F.coalesce("root", "cls").alias("root")
    )
    classes = written(classes, "jaccard-classes")
    least = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = classes.join(least, "root").select("cls", "component_id")
    return members.join(labels, "cls", "left").select(
        key,
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", F.col(key)).alias("component_id"),
    )
