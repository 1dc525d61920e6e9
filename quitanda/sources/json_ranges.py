"""Elements of large JSON documents, found by byte ranges.

A document is read as text that ends at each closing brace, so Spark splits it like any text
file and many tasks share one document. Whether a range starts inside a string, and how
deep, depends on all text before it. So a first pass sums up each range for both cases: whether
its quotes turn text into string, how far it opens or closes brackets, and at which depths
braces close. From these sums, one row per split, follows where each range starts. A second
pass cuts the ranges at the ends of elements. An element that spans ranges comes in pieces,
which are put together by a shuffle of these pieces alone.

Functions of this module travel to the Python workers by value, so that executors need no
copy of the package on their path.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quitanda.settings import spread

cloudpickle.register_pickle_by_value(sys.modules[__name__])


class BrokenDocument(ValueError):
    """A document whose strings or brackets do not end."""


# What is wrong with a text, told to the reader next to it.
MALFORMED, NO_OBJECT = "malformed", "no object"

_QUOTE, _BACKSLASH, _CLOSE = ord('"'), ord("\\"), ord("}")
_STEPS = np.zeros(256, np.int8)
_STEPS[[ord("{"), ord("[")]] = 1
_STEPS[[ord("}"), ord("]")]] = -1
_BLANK = np.zeros(256, bool)
_BLANK[list(b" \t\r\n")] = True

_NEXT_ELEMENT = r"^[ \t\r\n]*,[ \t\r\n]*\{"


def _quotes(text: np.ndarray) -> np.ndarray:
    """Places of the quotes that begin or end a string."""
    quotes = np.flatnonzero(text == _QUOTE)
    after = quotes[(quotes > 0) & (text[quotes - 1] == _BACKSLASH)]
    if len(after):
        # A quote counts unless the backslashes right before it are odd in number.
        other = np.flatnonzero(text != _BACKSLASH)
        last = np.searchsorted(other, after) - 1
        start = np.where(last >= 0, other[last], -1) + 1
        escaped = after[(after - start) % 2 == 1]
        quotes = np.setdiff1d(quotes, escaped, assume_unique=True)
    return quotes


def _events(text: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Brackets of a text that ends with a brace: places, steps in depth, and whether an odd
    number of quotes stands before; and the number of quotes."""
    steps = _STEPS[text]
    at = np.flatnonzero(steps)
    quotes = _quotes(text)
    odd = (np.searchsorted(quotes, at) % 2).astype(bool)
    return at, steps[at].astype(np.int64), odd, len(quotes)


Key = tuple[int, int, int, int]


def _fragments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Key, pa.Array]]:
    """Fragments with the brace that ended them, in runs of the same range."""
    brace = [pa.scalar(text, pa.large_binary()) for text in (b"", b"}")]
    for batch in batches:
        keys = [np.asarray(batch.column(i)) for i in (1, 2, 3, 4)]
        change = np.zeros(batch.num_rows, bool)
        for key in keys:
            change[1:] |= key[1:] != key[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for low, high in zip(cuts, cuts[1:]):
            if low < high:
                part = batch.column(0).slice(low, high - low).cast(pa.binary())
                closed = pc.binary_join_element_wise(part.cast(pa.large_binary()), *brace)
                yield tuple(int(key[low]) for key in keys), closed


def _bytes_of(fragments: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all fragments together, and where each ends."""
    _, offsets, data = fragments.buffers()
    ends = np.frombuffer(offsets, np.int64)[fragments.offset : fragments.offset + len(fragments) + 1]
    text = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data is not None else _STEPS[:0]
    return text.view(np.uint8), ends[1:] - ends[0]


@dataclass
class RangeSum:
    """What a range of a document does to the state of the text, for both states it may start in.

    Lists have an entry for a start outside a string and one for a start inside.
    """

    fragments: int = 0
    size: int = 0
    quotes: int = 0
    first: int = 0
    depth: list[int] = field(default_factory=lambda: [0, 0])
    closes: list[set[int]] = field(default_factory=lambda: [set(), set()])
    last: list[int | None] = field(default_factory=lambda: [None, None])

    def add(self, fragments: pa.Array) -> None:
        text, ends = _bytes_of(fragments)
        at, steps, odd, quotes = _events(text)
        is_end = np.zeros(len(text), bool)
        is_end[ends - 1] = True
        for start in (0, 1):
            outside = odd == bool((self.quotes + start) % 2)
            depth = self.depth[start] + np.cumsum(steps * outside)
            # The last brace of a document may not be there: it is kept apart.
            if self.last[start] is not None:
                self.closes[start].add(self.last[start])
            closing = outside & is_end[at]
            values = depth[closing]
            last = bool(len(at)) and bool(closing[-1])
            self.last[start] = int(values[-1]) if last else None
            self.closes[start].update(np.unique(values[:-1] if last else values).tolist())
            self.depth[start] = int(depth[-1]) if len(depth) else self.depth[start]
        if not self.first:
            given = np.flatnonzero(~_BLANK[text])
            # The brace added to a fragment of blanks is no first character of a value.
            self.first = int(text[given[0]]) if len(given) else 0
        self.quotes += quotes
        self.fragments += len(fragments)
        self.size += len(text) - len(fragments)


_SUM_SCHEMA = (
    "file bigint, start bigint, length bigint, stored bigint, fragments bigint, size bigint, "
    "quotes bigint, "
    "first int, depth array<bigint>, closes array<array<bigint>>, last array<bigint>"
)


def _sum_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for key, runs in groupby(_fragments(batches), key=lambda run: run[0]):
        total = RangeSum()
        for _, fragments in runs:
            total.add(fragments)
        columns = [[value] for value in key]
        columns += [[total.fragments], [total.size], [total.quotes % 2], [total.first]]
        columns += [[total.depth], [[sorted(c) for c in total.closes]], [total.last]]
        kinds = [pa.int64()] * 7 + [pa.int32(), pa.list_(pa.int64())]
        kinds += [pa.list_(pa.list_(pa.int64())), pa.list_(pa.int64())]
        names = [name.split()[0] for name in _SUM_SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, kind) for values, kind in zip(columns, kinds)], names
        )


@dataclass(frozen=True)
class RangeStart:
    """Where a range starts: in a string or not, how deep, and after how many ranges with ends.

    ``level`` is the depth at which the elements of the document end. The fragment numbered
    ``open_fragment`` ends with the document and not with a brace.
    """

    inside: bool
    depth: int
    level: int
    chain: int
    open_fragment: int


@dataclass(frozen=True)
class Document:
    """Number of the document's last chain, which has no element, and whether it is a list."""

    last_chain: int
    is_list: bool


def range_starts(sums: list) -> tuple[dict[Key, RangeStart], dict[int, Document]]:
    """Starts of all ranges, and the documents, from the sums of the ranges."""
    starts: dict[Key, RangeStart] = {}
    documents = {}
    ordered = sorted(sums, key=lambda row: (row.file, row.start))
    for file, rows in groupby(ordered, key=lambda row: row.file):
        rows = list(rows)
        first = next((row.first for row in rows if row.first), 0)
        level = 1 if first == ord("[") else 0
        inside, depth, chain = 0, 0, 0
        for row in rows:
            is_last = row is rows[-1]
            after = row.last[inside]
            ended = depth + after if after is not None else None
            is_open = is_last and not _closes(rows, depth + row.depth[inside], inside ^ row.quotes)
            starts[file, row.start, row.length, row.stored] = RangeStart(
                bool(inside), depth, level, chain, row.fragments - 1 if is_open else -1
            )
            has_end = level - depth in row.closes[inside] or (ended == level and not is_open)
            chain += has_end
            depth += row.depth[inside] + (is_open and after is not None)
            inside ^= row.quotes
        if inside or depth:
            raise BrokenDocument("a document of the feed does not end")
        documents[file] = Document(chain, level == 1)
    return starts, documents


def _closes(rows: list, depth: int, inside: int) -> bool:
    """Whether the last fragment of a document ends with a brace, which a reader can't tell.

    The length of the document says so. Where that is unknown, as it is compressed, its brackets
    must match. A mark of the byte order, which readers skip, takes three bytes.
    """
    size = rows[0].stored
    if size < 0:
        return depth == 0 and not inside
    given = sum(row.size + row.fragments for row in rows)
    return size - given in (0, 3)


_PIECE_SCHEMA = "whole boolean, file bigint, chain bigint, start bigint, value string, fault string"


def _cut(
    batches: Iterator[pa.RecordBatch], starts: dict[Key, RangeStart], documents: dict[int, Document]
) -> Iterator[pa.RecordBatch]:
    """Elements that lie in one range, and the pieces at both ends of each range."""
    names = [name.split()[0] for name in _PIECE_SCHEMA.split(", ")]

    def piece(key, chain, value, whole=False, fault=None):
        values = [[whole], [key[0]], [chain], [key[1]], [value], [fault]]
        kinds = [pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], names)

    for key, runs in groupby(_fragments(batches), key=lambda run: run[0]):
        if key not in starts:
            raise RuntimeError("the splits of the feed have changed while it was read")
        at = starts[key]
        inside, depth, chain, seen, rest = int(at.inside), at.depth, at.chain, 0, b""
        in_head = True
        for _, fragments in runs:
            text, ends = _bytes_of(fragments)
            if seen <= at.open_fragment < seen + len(fragments):
                text, ends = text[:-1], ends[:-1]
            seen += len(fragments)
            places, steps, odd, quotes = _events(text)
            outside = odd == bool(inside)
            depths = depth + np.cumsum(steps * outside)
            is_end = np.zeros(len(text), bool)
            is_end[ends - 1] = True
            cuts = places[outside & is_end[places] & (depths == at.level)] + 1
            depth = int(depths[-1]) if len(depths) else depth
            inside ^= quotes % 2
            body = rest + text.tobytes()
            cuts = cuts + len(rest)
            if len(cuts) and in_head:
                head = body[: cuts[0]].decode(errors="replace")
                if key[1] == 0:
                    # The first range begins with a whole element.
                    for value, fault in _chain_rows(documents[key[0]], 0, head):
                        yield piece(key, chain, value, True, fault)
                else:
                    yield piece(key, chain, head)
                chain, in_head = chain + 1, False
                body, cuts = body[cuts[0] :], cuts[1:] - cuts[0]
            if len(cuts):
                offsets = np.r_[0, cuts].astype(np.int64)
                value = pa.LargeBinaryArray.from_buffers(
                    pa.large_binary(), len(cuts), [None, pa.py_buffer(offsets), pa.py_buffer(body)]
                )
                yield _elements(value, names)
                body = body[cuts[-1] :]
            rest = body
        if rest:
            yield piece(key, chain, rest.decode(errors="replace"))


def _elements(value: pa.LargeBinaryArray, names: list[str]) -> pa.RecordBatch:
    """Elements of a list without the comma before them; other values between are a fault."""
    rows = len(value)
    good = pc.match_substring_regex(value, _NEXT_ELEMENT)
    element = pc.replace_substring_regex(value, _NEXT_ELEMENT, "{", max_replacements=1)
    faults: list[str | None] = [None] * rows
    for i in np.flatnonzero(~np.asarray(good, bool)).tolist():
        faults[i] = _fault("[0" + value[i].as_py().decode(errors="replace") + "]")
    nulls = pa.nulls(rows, pa.int64())
    whole = pa.array(np.ones(rows, bool))
    columns = [whole, nulls, nulls, nulls, element.cast(pa.string(), safe=False), pa.array(faults, pa.string())]
    return pa.RecordBatch.from_arrays(columns, names)


def _fault(document: str) -> str | None:
    """What is wrong with a list of which not all elements are objects, if it is JSON at all."""
    try:
        found = json.loads(document)
    except (ValueError, RecursionError):
        return MALFORMED
    return NO_OBJECT if isinstance(found, list) and len(found) > 0 else None


def _joined(
    batches: Iterator[pa.RecordBatch], documents: dict[int, Document]
) -> Iterator[pa.RecordBatch]:
    """Whole elements and ends of documents, from the text of each chain."""
    for batch in batches:
        found = [
            row
            for file, chain, text in zip(*[column.to_pylist() for column in batch.columns])
            for row in _chain_rows(documents[file], chain, text)
        ]
        values, faults = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays(
            [pa.array(values, pa.string()), pa.array(faults, pa.string())], ["value", "fault"]
        )


def _chain_rows(document: Document, chain: int, text: str) -> list[tuple[str, str | None]]:
    """The element that a chain of pieces is, or what is wrong with it; the end has no row."""
    text = text.lstrip("﻿") if chain == 0 else text
    if chain < document.last_chain:
        if chain == 0 and not document.is_list:
            return [(text, None)]
        before = "[" if chain == 0 else ","
        bare = text.lstrip(" \t\r\n")
        if bare[:1] == before and bare[1:].lstrip(" \t\r\n")[:1] == "{":
            return [(bare[1:].lstrip(" \t\r\n"), None)]
        return [("", _fault(text + "]" if chain == 0 else "[0" + text + "]"))]
    if chain == 0:
        # A document without an object: no record, and no fault but in a list with elements.
        fault = _fault(text) if text.strip(" \t\r\n") else None
    elif document.is_list:
        fault = None if text.strip(" \t\r\n") == "]" else _fault("[0" + text)
    else:
        fault = MALFORMED if text.strip(" \t\r\n") else None
    return [("", fault)] if fault else []


_COMPRESSED = r"\.(gz|bz2|zst|zstd|lz4|snappy|deflate)$"


def document_elements(spark: SparkSession, path: str) -> DataFrame:
    """Rows (value, fault) for the documents at a path: the text of each object that is one or
    is an element of a list. A row with a fault stands for a text that is no JSON, or a list with
    other elements. Documents are UTF-8.

    The first pass runs at once; it raises ``BrokenDocument`` where the end is missing. What it collects is a row for each split of the feed, as the
    driver itself holds for the tasks of the read.
    """
    meta = F.col("_metadata")
    is_stored = ~F.lower(meta["file_path"]).rlike(_COMPRESSED)
    ranges = (
        spark.read.option("lineSep", "}")
        .text(path)
        .select(
            "value",
            F.xxhash64(meta["file_path"]).alias("file"),
            meta["file_block_start"].alias("start"),
            meta["file_block_length"].alias("length"),
            F.when(is_stored, meta["file_size"]).otherwise(-1).alias("stored"),
        )
    )
    starts, documents = range_starts(ranges.mapInArrow(_sum_ranges, _SUM_SCHEMA).collect())
    shared = spark.sparkContext.broadcast((starts, documents))
    pieces = ranges.mapInArrow(lambda batches: _cut(batches, *shared.value), _PIECE_SCHEMA)
    whole = spread(pieces.where("whole")).select("value", "fault")
    in_order = F.sort_array(F.collect_list(F.struct("start", "value")))
    chains = pieces.where(~F.col("whole")).groupBy("file", "chain")
    chains = chains.agg(F.array_join(in_order["value"], "").alias("value"))
    ends = chains.mapInArrow(
        lambda batches: _joined(batches, shared.value[1]), "value string, fault string"
    )
    return whole.union(ends)
