"""SentencePiece BPE in numpy: merge rounds over many words at once."""

from __future__ import annotations

import heapq
import re
from collections import ChainMap
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quitanda.llm.common import map_batches

SPACE = "▁"
_SEGMENT = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_CACHED_WORDS = 300_000
# Words above this many symbols are merged one by one from a heap: rounds would cost the
# square of their length. Both give the same pieces.
_ROUND_SYMBOLS = 128
_NEVER = 1 << 40


# A word's pieces: how many, their ids joined by commas, and their decoded bytes.
Encoded = tuple[int, str, bytes]


class PieceModel:
    """Vocabulary, pair ranks and byte pieces of a BPE model whose normalizer is the identity."""

    def __init__(self, model_path: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=model_path)
        if model.normalize("  ﬁ① ") != f"{SPACE * 3}ﬁ①{SPACE}":
            raise ValueError("only models that leave texts as they are can be used")
        normal = [
            i
            for i in range(len(model))
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.names = {i: model.id_to_piece(i) for i in normal}
        self._names = {i: str(i) for i in normal}
        self.byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(SPACE in name.lstrip(SPACE) for name in self.names.values()):
            raise ValueError("pieces that run over a word's start can't be used")
        self._texts = {i: name.replace(SPACE, " ").encode() for i, name in self.names.items()}
        self._texts |= {i: bytes([b]) for b, i in enumerate(self.byte_ids)}
        ids = {name: i for i, name in self.names.items()}
        scores = sorted({model.get_score(i) for i in normal}, reverse=True)
        order = {score: rank for rank, score in enumerate(scores)}
        ranks = {i: order[model.get_score(i)] for i in normal}

        # Symbols: pieces by id, then single characters that only occur inside pieces.
        self.symbols, self.first_char = dict(ids), len(model)
        for name in list(ids):
            for char in name:
                self.symbols.setdefault(char, len(model) + len(self.symbols))
        self.width = max(self.symbols.values()) + 2
        self.unknown = self.width - 1
        pairs = {}
        for name, i in ids.items():
            for cut in range(1, len(name)):
                left, right = self.symbols.get(name[:cut]), self.symbols.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = (ranks[i], i)
        self.pairs = pairs
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()], np.int64)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()], np.int64)

    def look_up(self, left, right):
        """Rank and merged symbol of each pair; the rank is ``_NEVER`` for one without a piece."""
        import numpy as np

        wanted = left * self.width + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        found = self.keys[at] == wanted
        return np.where(found, self.ranks[at], _NEVER), self.merged[at]

    def merge_rounds(self, words: list[list[int]]):
        """Symbols left after all merges, and with each its word and its first character's place.

        All words lie in one flat array. In each round every word finds the best rank of its
        pairs and merges the leftmost pair that has it; the array is then compacted. Words
        without a pair left leave it every few rounds.
        """
        import numpy as np

        lengths = np.array([len(word) for word in words], np.int64)
        symbol = np.fromiter((s for word in words for s in word), np.int64, int(lengths.sum()))
        owner = np.repeat(np.arange(len(words)), lengths)
        place = np.arange(len(symbol)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        done: list[tuple] = []
        rank = np.full(len(symbol), _NEVER, np.int64)
        merged = np.zeros(len(symbol), np.int64)

        def rate(at):
            """Ranks of the pairs that begin at ``at``, where a symbol of the word follows."""
            at = at[at + 1 < len(symbol)]
            at = at[owner[at] == owner[at + 1]]
            rank[at], merged[at] = self.look_up(symbol[at], symbol[at + 1])

        rate(np.arange(len(symbol)))
        while len(symbol):
            firsts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[firsts, len(owner)])
            best = np.minimum.reduceat(rank, firsts)
            open_words = best < _NEVER
            if 4 * np.count_nonzero(open_words) <= 3 * len(best):
                active = np.repeat(open_words, sizes)
                done.append((owner[~active], symbol[~active], place[~active]))
                symbol, owner, place = symbol[active], owner[active], place[active]
                rank, merged = rank[active], merged[active]
                continue
            hits = np.flatnonzero((rank == np.repeat(best, sizes)) & (rank < _NEVER))
            hits = hits[np.r_[True, owner[hits[1:]] != owner[hits[:-1]]]]
            symbol[hits] = merged[hits]
            left = np.ones(len(symbol), bool)
            left[hits + 1] = False
            rank[hits] = _NEVER
            moved = hits - np.arange(len(hits))
            symbol, owner, place = symbol[left], owner[left], place[left]
            rank, merged = rank[left], merged[left]
            before = moved[moved > 0] - 1
            before = before[owner[before] == owner[before + 1]]
            rate(np.concatenate([moved, before]))
        if not done:
            return symbol, owner, place
        owner, symbol, place = (np.concatenate(column) for column in zip(*done))
        order = np.argsort(owner, kind="stable")
        return symbol[order], owner[order], place[order]

    def merge_long(self, word: list[int]) -> list[tuple[int, int]]:
        """The same for one long word: best rank first, then leftmost, from a heap."""
        symbol, following = list(word), list(range(1, len(word))) + [-1]
        previous = list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, int, int, int]] = []

        def offer(left: int) -> None:
            right = following[left] if left >= 0 else -1
            if right >= 0:
                pair = self.pairs.get(symbol[left] * self.width + symbol[right])
                if pair:
                    heapq.heappush(heap, (pair[0], left, symbol[left], symbol[right], pair[1]))

        for at in range(len(word)):
            offer(at)
        while heap:
            _, left, first, second, merged = heapq.heappop(heap)
            right = following[left] if symbol[left] == first else -1
            if right < 0 or symbol[right] != second:
                continue
            symbol[left], symbol[right] = merged, -1
            following[left] = following[right]
            if following[right] >= 0:
                previous[following[right]] = left
            offer(previous[left])
            offer(left)
        return [(s, at) for at, s in enumerate(symbol) if s >= 0]

    def encode_words(self, words: list[str]) -> list[Encoded]:
        import numpy as np

        rows = [[self.symbols.get(char, self.unknown) for char in word] for word in words]
        rounds = [row if len(row) <= _ROUND_SYMBOLS else [] for row in rows]
        symbol, owner, place = self.merge_rounds(rounds)
        edges = np.searchsorted(owner, np.arange(len(rows) + 1)).tolist()
        strange = np.bincount(owner[symbol >= self.first_char], minlength=len(rows)).tolist()
        symbol, place = symbol.tolist(), place.tolist()
        names = [self._names.get(s, "") for s in symbol]
        texts = [self._texts.get(s, b"") for s in symbol]
        found = []
        for word, row, i, j, odd in zip(words, rows, edges, edges[1:], strange):
            if len(row) > _ROUND_SYMBOLS:
                found.append(self._spelled(word, self.merge_long(row)))
            elif odd:
                found.append(self._spelled(word, list(zip(symbol[i:j], place[i:j]))))
            else:
                found.append((j - i, ",".join(names[i:j]), b"".join(texts[i:j])))
        return found

    def _spelled(self, word: str, pieces: list[tuple[int, int]]) -> Encoded:
        """A word with characters that have no piece and are spelled in bytes."""
        ids: list[int] = []
        for symbol, place in pieces:
            if symbol < self.first_char:
                ids.append(symbol)
            else:
                ids.extend(self.byte_ids[b] for b in word[place].encode())
        return len(ids), ",".join(map(str, ids)), self.decode_pieces(ids)

    def decode_pieces(self, ids: list[int]) -> bytes:
        """Text of the pieces as bytes: spaces for their mark, byte pieces as what they stand for."""
        return b"".join(map(self._texts.__getitem__, ids))

    def decode(self, ids: list[int]) -> str:
        """Pieces to text, without the space that stands before the first word."""
        return self.decode_pieces(ids).decode(errors="replace").removeprefix(" ")


class TextEncoder:
    """Whole texts, with each distinct word merged once while the cache has room for it."""

    def __init__(self, model: PieceModel):
        self.model = model
        self._known: dict[str, Encoded] = {}

    def encode(self, texts: list[str]) -> Iterator[list[Encoded]]:
        """The words of each text in order; none for the empty text."""
        split = [words_of(text) for text in texts]
        known = self._known
        new = [word for word in set().union(*split) if word not in known]
        if new:
            found = dict(zip(new, self.model.encode_words(new)))
            if len(known) < _CACHED_WORDS:
                known.update(found)
            else:
                known = ChainMap(known, found)
        return (list(map(known.__getitem__, words)) for words in split)


def words_of(text: str) -> list[str]:
    """Spans that no merge runs over: spaces as marks, one before the text, and what follows."""
    if not text:
        return []
    if "  " in text or SPACE in text or text[0] == " " or text[-1] == " ":
        return _SEGMENT.findall((SPACE + text).replace(" ", SPACE))
    return (SPACE + text.replace(" ", " " + SPACE)).split(" ")


def summed(words: list[Encoded]) -> tuple[int, str, str]:
    """Number of ids, the ids joined by commas, and the decoded text of a list of words."""
    joined = ",".join([word[1] for word in words])
    text = b"".join([word[2] for word in words]).decode(errors="replace")
    return sum([word[0] for word in words]), joined, text.removeprefix(" ")


def encode_and_decode(
    docs: DataFrame, model_path: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """One row per input row: key, n_tokens, ids (decimal, joined by commas), decoded.

    Ids are those of the sentencepiece library without begin, end or sampling. A null text
    counts as empty: no ids, and it decodes to the empty text. Repeated rows give repeated
    results; other columns are not read. No shuffle.
    """

    def start():
        encoder = TextEncoder(PieceModel(model_path))

        def rows(keys, bodies):
            encoded = encoder.encode([body or "" for body in bodies])
            return [(key, *summed(words)) for key, words in zip(keys, encoded)]

        return rows

    kind = dict(docs.dtypes)[key]
    encoded = map_batches(
        docs.select(F.col(key).alias("k"), F.col(text).alias("t")),
        start,
        f"k {kind}, n_tokens bigint, ids string, decoded string",
    )
    return encoded.withColumnRenamed("k", key)
