"""Byte-pair pieces of a sentencepiece model: vocabulary, heap merging, marked words."""

from __future__ import annotations

import heapq
import re
import sys
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece

MARK = "▁"
# Texts that any normalisation but the identity would change.
NORMAL_FORMS = "Ａ é é ﬁ ½  x　y ﷺ Straße ǅ"


class Pieces:
    """The vocabulary of a BPE model, and how texts fall into words that no piece crosses."""

    def __init__(self, path: str) -> None:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.begin, self.end, self.unknown = model.bos_id(), model.eos_id(), model.unk_id()
        self.pieces = [model.id_to_piece(i) for i in range(size)]
        special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) for i in range(size)]
        self.special = special
        self.bytes = {int(self.pieces[i][3:5], 16): i for i in range(size) if model.is_byte(i)}
        ordinary = [i for i in range(size) if not special[i] and not model.is_byte(i)]
        self.ids = {self.pieces[i]: i for i in ordinary}
        self.scores = {self.pieces[i]: model.get_score(i) for i in ordinary}
        self.normalizer = sentencepiece.SentencePieceNormalizer(model_file=path)
        probe = "".join(model.encode(NORMAL_FORMS + "  x ", out_type=str))
        plain = model.decode(model.encode(NORMAL_FORMS)) == NORMAL_FORMS
        self.prefix = probe.startswith(MARK)
        self.identity = plain and self.normalizer.normalize(" a  b ") == f"{MARK * 2}a{MARK * 2}b{MARK}"
        crossing = any(MARK in piece.lstrip(MARK) for piece in self.ids)
        newline = any("\n" in piece for piece in self.ids)
        # A word is its leading marks and what follows; line ends are words of their own if no piece holds them.
        self.words = re.compile("(?s).+" if crossing else f"{MARK}*[^{MARK}]+|{MARK}+" if newline else f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")

    def split(self, text: str) -> list[str]:
        """The words of the normalised text; joined they give it back."""
        if not text:
            return []
        if self.identity:
            text = text.replace(" ", MARK)
            return self.words.findall(MARK + text if self.prefix else text)
        return self.words.findall(self.normalizer.normalize(text))

    def merged(self, word: str) -> list[str]:
        """The symbols after all merges, merged-away ones empty: pop the best adjacent pair, leftmost first, until none is left.

        A linked list over the characters; a heap entry is stale when one of its two symbols has changed since.
        """
        symbols = list(word)
        n = len(symbols)
        following = list(range(1, n)) + [-1]
        before = list(range(-1, n - 1))
        scores, heap = self.scores, []
        for i in range(n - 1):
            pair = symbols[i] + symbols[i + 1]
            if pair in scores:
                heap.append((-scores[pair], i, pair))
        heapq.heapify(heap)
        while heap:
            _, i, pair = heapq.heappop(heap)
            j = following[i]
            if j < 0 or not symbols[i] or len(symbols[i]) + len(symbols[j]) != len(pair) or symbols[i] + symbols[j] != pair:
                continue
            symbols[i], symbols[j] = pair, ""
            after = following[i] = following[j]
            if after >= 0:
                before[after] = i
                new = pair + symbols[after]
                if new in scores:
                    heapq.heappush(heap, (-scores[new], i, new))
            left = before[i]
            if left >= 0:
                new = symbols[left] + pair
                if new in scores:
                    heapq.heappush(heap, (-scores[new], left, new))
        return symbols

    def count(self, word: str) -> int:
        """Initial symbols minus merges; a character outside the vocabulary is as many symbols as it has bytes."""
        symbols = self.merged(word)
        return sum(1 if s in self.ids or not self.bytes else len(s.encode()) for s in symbols if s)

    def encode(self, word: str) -> list[int]:
        symbols = self.merged(word)
        ids: list[int] = []
        for symbol in symbols:
            if symbol:
                known = self.ids.get(symbol)
                if known is not None:
                    ids.append(known)
                elif self.bytes:
                    ids.extend(self.bytes[b] for b in symbol.encode())
                else:
                    ids.append(self.unknown)
        return ids


@lru_cache(maxsize=4)
def pieces(path: str) -> Pieces:
    """Loaded once in each Python worker."""
    return Pieces(path)


# Rows of a batch that are worked on, and given on, at a time.
PART_ROWS = 128
# Bytes of the table of distinct words in each Python worker.
TABLE_BYTES = 128 << 20


def row_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in parts of PART_ROWS rows, so that what a task makes of them is small however many rows a batch has."""
    for batch in batches:
        for first in range(0, max(1, batch.num_rows), PART_ROWS):
            yield batch.slice(first, PART_ROWS)


class WordTable(dict):
    """word -> value, made once for each distinct word; bounded in bytes by starting anew, long words are not kept."""

    def __init__(self, make, size: int = TABLE_BYTES, length: int = 48) -> None:
        super().__init__()
        self.make, self.size, self.length = make, size, length
        self.held = 0

    def __missing__(self, word: str):
        value = self.make(word)
        if len(word) <= self.length:
            # An entry of the dictionary, the word, and the value with what it holds.
            self.held += 120 + sys.getsizeof(word) + sys.getsizeof(value) + (36 * len(value) if isinstance(value, tuple) else 0)
            if self.held > self.size:
                self.clear()
                self.held = 0
            self[word] = value
        return value
