"""Packing by powers of two: every sequence is one piece of one document, without padding."""

from __future__ import annotations

import re
from collections import ChainMap
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import map_batches

SEQUENCE = 1024
END_ID = 0

# A cut before a space that a non-space follows never splits a pre-token. Texts with other
# spaces are encoded as they are.
_RUN = re.compile(r" (?:\s|$)")
_CACHED_WORDS = 300_000


def piece_lengths(n_tokens: int, sequence: int = SEQUENCE) -> Iterator[int]:
    """Whole sequences first, then the binary digits of the rest, largest first."""
    yield from [sequence] * (n_tokens // sequence)
    rest, length = n_tokens % sequence, sequence
    while rest:
        length //= 2
        if rest >= length:
            yield length
            rest -= length


def byte_level(tokens: Iterable[str]) -> Iterator[bytes]:
    """Bytes that byte-level vocabulary entries stand for.

    Printable Latin-1 characters stand for themselves, and those from 256 on for the other
    bytes in order.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in own]
    table = {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}
    return (bytes(map(table.__getitem__, token)) for token in tokens)


def read_encoding(tokenizer_path: str, pattern: str):
    """The tokenizer of a tokenizers file as a tiktoken encoding, which gives the same ids."""
    import json

    import tiktoken

    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = json.load(file)
    special = {token["content"]: token["id"] for token in tokenizer["added_tokens"]}
    vocabulary = {t: i for t, i in tokenizer["model"]["vocab"].items() if t not in special}
    ranks = dict(zip(byte_level(vocabulary), vocabulary.values()))
    return tiktoken.Encoding(
        "packing", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special
    )


class DocumentEncoder:
    """Token ids of whole texts as little-endian 32-bit bytes.

    Words are encoded once while there is room for them in the cache; the words that a batch
    of texts adds go through the tokenizer as one text and are told apart by their space.
    """

    def __init__(self, tokenizer_path: str, pattern: str):
        import numpy as np

        self._encoding = read_encoding(tokenizer_path, pattern)
        self._starts = np.zeros(self._encoding.n_vocab, bool)
        for token, i in self._encoding._mergeable_ranks.items():
            self._starts[i] = token.startswith(b" ")
        self._words: dict[str, bytes] = {}

    def _ids(self, text: str):
        import numpy as np

        return np.array(self._encoding.encode(text, allowed_special="all"), "<u4")

    def _encode_words(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        import numpy as np

        ids = self._ids(" " + " ".join(words))
        edges = [*(4 * np.flatnonzero(self._starts[ids])).tolist(), 4 * len(ids)]
        raw = ids.tobytes()
        return ((w, raw[i:j]) for w, i, j in zip(words, edges, edges[1:]))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        split = [None if _RUN.search(text) else text.split(" ") for text in texts]
        words = self._words
        new = {w for own in split if own for w in own[1:] if w not in words}
        if new:
            found = dict(self._encode_words(list(new)))
            if len(words) < _CACHED_WORDS:
                words.update(found)
                found = {}
            words = ChainMap(words, found) if found else words
        for text, own in zip(texts, split):
            if own is None:
                yield self._ids(text).tobytes()
            else:
                yield self._ids(own[0]).tobytes() + b"".join(map(words.__getitem__, own[1:]))


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    pattern: str,
    key: str = "doc_id",
    text: str = "text",
    sequence: int = SEQUENCE,
) -> DataFrame:
    """Pieces of all documents: key, start, length, bucket, ids, doc_tokens, sequence_id, offset.

    A document is its ids and then ``END_ID``. It is cut into whole sequences and, for the
    rest, one piece for each binary digit of its length. Each piece is a sequence of its own
    (offset 0), so its length is a power of two, no sequence crosses documents and none is
    padded. ``bucket`` is the exponent of the length: batches are drawn from one bucket.
    ``ids`` holds unsigned little-endian 32-bit integers. ``pattern`` is the regular
    expression by which the tokenizer parts words.

    A null text counts as empty: one piece with ``END_ID`` alone. Rows with the same key or
    text are packed each on its own. One narrow stage, no shuffle; sequence ids come from
    the place of a piece in the scan, so a task run again gives the same ones.
    """
    if sequence & (sequence - 1):
        raise ValueError("sequence must be a power of two")

    def start_encoder():
        encoder = DocumentEncoder(tokenizer_path, pattern)
        end = END_ID.to_bytes(4, "little")

        def cut(k, ids):
            total, start = len(ids) // 4, 0
            for length in piece_lengths(total, sequence):
                piece = ids[4 * start : 4 * (start + length)]
                yield k, start, length, length.bit_length() - 1, piece, total
                start += length

        def rows(keys, texts):
            encoded = encoder.encode([text or "" for text in texts])
            return [piece for k, ids in zip(keys, encoded) for piece in cut(k, ids + end)]

        return rows

    kind = dict(docs.dtypes)[key]
    pieces = map_batches(
        docs.select(F.col(key).alias("k"), F.col(text).alias("t")),
        start_encoder,
        f"k {kind}, start bigint, length bigint, bucket int, ids binary, doc_tokens bigint",
    )
    return pieces.withColumnRenamed("k", key).withColumns(
        {"sequence_id": F.monotonically_increasing_id(), "offset": F.lit(0).cast("bigint")}
    )


def write_buckets(pieces: DataFrame, path: str) -> None:
    """One folder per length, each of equal sequences to draw batches from."""
    pieces.write.partitionBy("bucket").parquet(path)
