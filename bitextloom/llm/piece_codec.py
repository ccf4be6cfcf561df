"""SentencePiece encoding through a table of distinct marked words, and decoding by gathering piece bytes."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from bitextloom.llm.pieces import MARK, TABLE_BYTES, WordTable, pieces, row_parts
from bitextloom.llm.tables import text_or_empty


def encode_texts(docs: DataFrame, model: str, table_bytes: int = TABLE_BYTES) -> DataFrame:
    """One row per row of `docs`: doc_id and ids, the begin id, the pieces' ids and the end id, as
    little-endian unsigned 32-bit integers in one binary.

    Where no piece crosses a whitespace marker a marked word is segmented once for each worker's table and
    the ids are joined back in the order of the words. A null or empty text has begin and end alone. A worker's table
    takes up to `table_bytes`; a smaller one segments more words again and changes no result.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        table = WordTable(lambda word: np.array(vocabulary.encode(word), "<u4").tobytes(), table_bytes)
        first, last = np.array(vocabulary.begin, "<u4").tobytes(), np.array(vocabulary.end, "<u4").tobytes()
        for batch in row_parts(batches):
            ids = [
                first + b"".join(map(table.__getitem__, vocabulary.split(text))) + last
                for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return docs.select("doc_id", text_or_empty().alias("text")).mapInArrow(encode, f"doc_id {kind}, ids binary")


class PieceBytes:
    """What each id stands for, laid end to end, to be gathered for a whole text at once."""

    def __init__(self, model: str) -> None:
        vocabulary = pieces(model)
        self.prefix = vocabulary.prefix
        byte_of = {i: b for b, i in vocabulary.bytes.items()}
        parts = []
        for i, piece in enumerate(vocabulary.pieces):
            if i in byte_of:
                parts.append(bytes([byte_of[i]]))
            elif i == vocabulary.unknown:
                parts.append(" ⁇ ".encode())
            else:
                parts.append(b"" if vocabulary.special[i] else piece.replace(MARK, " ").encode())
        self.lengths = np.array([len(p) for p in parts])
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.all = np.frombuffer(b"".join(parts), np.uint8)
        self.control = np.array([s and i != vocabulary.unknown for i, s in enumerate(vocabulary.special)])
        self.is_byte = np.zeros(len(parts), bool)
        self.is_byte[list(byte_of)] = True
        # A first piece that starts with a marker loses it: encoding had put it there.
        self.marked = np.array([p.startswith(MARK) for p in vocabulary.pieces])

    def decode(self, ids: np.ndarray) -> str:
        real = np.flatnonzero(~self.control[ids])
        if not len(real):
            return ""
        ids = ids[real[0] : real[-1] + 1]
        try:
            # A control id inside ends a run of byte pieces, though it stands for nothing.
            text = self.by_runs(ids) if len(real) < len(ids) else self.gather(ids).decode()
        except UnicodeDecodeError:
            text = self.by_runs(ids)
        return text[1:] if self.prefix and self.marked[ids[0]] else text

    def gather(self, ids: np.ndarray) -> bytes:
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths, dtype=np.int64)
        shift = np.repeat(self.starts[ids] - (ends - lengths), lengths)
        return self.all[np.arange(ends[-1]) + shift].tobytes()

    def by_runs(self, ids: np.ndarray) -> str:
        """Byte pieces that are no whole character become replacement characters, one for each byte."""
        edges = np.flatnonzero(np.diff(self.is_byte[ids])) + 1
        out = []
        for run in np.split(ids, edges):
            data = self.gather(run)
            out.append(whole_characters(data) if self.is_byte[run[0]] else data.decode())
        return "".join(out)


CHARACTER = re.compile(
    rb"[\x00-\x7f]|[\xc2-\xdf][\x80-\xbf]|\xe0[\xa0-\xbf][\x80-\xbf]|[\xe1-\xec\xee\xef][\x80-\xbf]{2}|\xed[\x80-\x9f][\x80-\xbf]"
    rb"|\xf0[\x90-\xbf][\x80-\xbf]{2}|[\xf1-\xf3][\x80-\xbf]{3}|\xf4[\x80-\x8f][\x80-\xbf]{2}|[\x80-\xff]"
)


def whole_characters(data: bytes) -> str:
    """UTF-8 text, with a replacement character for each byte outside a well-formed character."""
    found = CHARACTER.findall(data)
    return "".join(c.decode() if len(c) > 1 or c < b"\x80" else "�" for c in found)


@lru_cache(maxsize=4)
def piece_bytes(model: str) -> PieceBytes:
    return PieceBytes(model)


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """`encoded` (doc_id, ids) with text, what the ids decode to; null ids decode to an empty text."""
    kind = encoded.schema["doc_id"].dataType.simpleString()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = piece_bytes(model)
        for batch in row_parts(batches):
            texts = [table.decode(np.frombuffer(ids or b"", "<u4")) for ids in batch.column("ids").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("ids"), pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(decode, f"doc_id {kind}, ids binary, text string")
