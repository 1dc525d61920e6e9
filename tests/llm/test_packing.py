from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quitanda.llm.packing import END_ID, SEQUENCE, DocumentEncoder, pack, piece_lengths, write_buckets
from tests.llm.helpers import ODD_TEXTS, clashing, docs_table

PATH = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@pytest.mark.parametrize("n", [1, 2, 3, 1023, 1024, 1025, 2047, 5000])
def test_pieces_are_powers_of_two_that_add_up(n):
    lengths = list(piece_lengths(n))
    assert sum(lengths) == n
    assert all(length & (length - 1) == 0 and length <= SEQUENCE for length in lengths)
    assert lengths == sorted(lengths, reverse=True)


def test_ids_equal_the_tokenizers_library(tokenizer):
    random.seed(5)
    parts = ["a", "the", " ", "  ", "\n", "\t", "é", "日", "🙂", "'s", "12", " 7", "!", "\xa0",
             "<|endoftext|>", "\u3000", "\r\n", "\x85", "\x00", "ing "]
    texts = ["".join(random.choices(parts, k=random.randint(0, 40))) for _ in range(1500)]
    texts += [t for t in ODD_TEXTS if t]
    encoder = DocumentEncoder(PATH, PATTERN)
    for start in range(0, len(texts), 100):
        some = texts[start : start + 100]
        for text, ids in zip(some, encoder.encode(some)):
            expected = tokenizer.encode(text, add_special_tokens=False).ids
            assert np.frombuffer(ids, "<u4").tolist() == expected


def test_a_full_cache_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr("quitanda.llm.packing._CACHED_WORDS", 3)
    encoder = DocumentEncoder(PATH, PATTERN)
    for text in ("one two three four five", "six seven one", "eight two nine"):
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(next(encoder.encode([text])), "<u4").tolist() == expected


def test_every_document_comes_back_from_its_pieces(spark, tokenizer):
    docs = clashing(docs_table(spark, ODD_TEXTS)).repartition(3)
    pieces = pack(docs, PATH, PATTERN).collect()
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    for i, text in enumerate(ODD_TEXTS):
        own = sorted((p for p in pieces if p.doc_id == i), key=lambda p: p.start)
        ids = b"".join(bytes(p.ids) for p in own)
        expected = [*tokenizer.encode(text or "", add_special_tokens=False).ids, END_ID]
        assert np.frombuffer(ids, "<u4").tolist() == expected
        at = 0
        for p in own:
            assert (p.start, p.offset, p.doc_tokens) == (at, 0, len(expected))
            assert p.length == 2**p.bucket == len(p.ids) // 4
            at += p.length


def test_repeated_rows_and_empty_tables(spark):
    docs = docs_table(spark, ["some text", "some text"])
    assert pack(docs.union(docs), PATH, PATTERN).count() == 2 * pack(docs, PATH, PATTERN).count()
    assert pack(docs.limit(0), PATH, PATTERN).count() == 0


def test_query_columns_and_buckets(spark, tmp_path):
    from pyspark.sql import functions as F

    pieces = pack(docs_table(spark, ["one two three"]), PATH, PATTERN)
    row = pieces.withColumn("crc", F.crc32("ids")).first()
    assert row.crc == zlib.crc32(bytes(row.ids))
    write_buckets(pieces, str(tmp_path / "buckets"))
    assert spark.read.parquet(str(tmp_path / "buckets/bucket=2")).count() == 1
