"""Lines that many documents hold: found with two Bloom filters, confirmed exactly, left in one document."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.bloom import suspected, twice_seen
from bitextloom.llm.tables import broadcast_if_small, stored, text_or_empty

MIN_LENGTH = 40
MIN_DOCUMENTS = 5
# Bits of the filters for each line, within 2^20 and 2^28 (32 MB) in all; a fuller filter only suspects more lines, which then
# shuffle for the exact count.
BITS_PER_LINE = 8
LEAST_BITS, MOST_BITS = 1 << 20, 1 << 28
# Lost lines that are broadcast, at 16 bytes each.
BROADCAST_LINES = 1_000_000


def line_keys(text: str, min_length: int) -> list[bytes | None]:
    """A key per line: stripped of ASCII white space, A-Z lower-cased; None where it is too short to count."""
    return [key if long_enough(key, min_length) else None for key in map(bytes.strip, text.encode().lower().split(b"\n"))]


def long_enough(key: bytes, min_length: int) -> bool:
    """Code points are at least a quarter of the bytes and at most as many."""
    return len(key) >= min_length and (len(key) >= 4 * min_length or len(key.decode()) >= min_length)


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def own_keys(text: str, min_length: int) -> set[bytes]:
    keys = set(line_keys(text, min_length))
    keys.discard(None)
    return keys


def filter_bits(texts: DataFrame) -> int:
    """Bits for the number of lines, a power of two."""
    ends = F.length("text") - F.length(F.replace("text", F.lit("\n")))
    lines = texts.agg(F.coalesce(F.sum(ends + 1), F.lit(0))).first()[0]
    return min(MOST_BITS, max(LEAST_BITS, 1 << (BITS_PER_LINE * lines).bit_length()))


def repeated_lines(docs: DataFrame, min_length: int, min_documents: int, bits: int | None) -> DataFrame:
    """doc_id and the digests of the lines it loses, for each document that loses any.

    Two passes over the texts: the first fills the filters, the second sends the digests of lines suspected
    to be in two documents. Counts and winners are exact, over digests of 128 bits.
    """
    texts = docs.select("doc_id", text_or_empty().alias("text"))

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        texts = batch.column("text").to_pylist()
        found = [xxhash.xxh3_64_intdigest(key) for text in texts for key in own_keys(text, min_length)]
        return np.array(found, np.uint64)

    twice = docs.sparkSession.sparkContext.broadcast(twice_seen(texts.select("text"), hashes, bits or filter_bits(texts)))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed = twice.value
        for batch in batches:
            owners, keys = [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = own_keys(text, min_length)
                owners.extend([row] * len(own))
                keys.extend(own)
            seen = suspected(packed, np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64))
            hit = np.flatnonzero(seen).tolist()
            ids = batch.column("doc_id").take(pa.array([owners[i] for i in hit], pa.int32()))
            yield pa.RecordBatch.from_arrays([ids, pa.array([digest(keys[i]) for i in hit], pa.binary())], ["doc_id", "line"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    lines = stored(texts.mapInArrow(suspects, f"doc_id {kind}, line binary"), "suspects")
    repeated = stored(
        lines.groupBy("line")
        .agg(F.count_distinct("doc_id").alias("n"), F.max("doc_id").alias("keep_id"))
        .filter(F.col("n") >= min_documents)
        .select("line", "keep_id"),
        "repeated",
    )
    lost = lines.join(broadcast_if_small(repeated), "line").filter(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
    lost = stored(lost.groupBy(F.col("doc_id").alias("loser")).agg(F.collect_set("line").alias("lost")), "lost-lines")
    gone = lost.agg(F.coalesce(F.sum(F.size("lost")), F.lit(0))).first()[0]
    return F.broadcast(lost) if gone <= BROADCAST_LINES else lost


def dedup_lines(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, bits: int | None = None
) -> DataFrame:
    """One row per row of `docs`: doc_id, text (what stays), n_lines, n_dropped.

    Lines whose key has `min_length` code points and is in `min_documents` documents stay only in the largest
    doc_id that holds them. A null or empty text is one empty line. Rows of one doc_id are one document, and are treated alike; rows
    without a doc_id are no document, but lose what they share with documents. `bits` is the size of the filters, by default from
    the number of lines. While the lines lost are few enough to broadcast, no text is shuffled.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    lost = repeated_lines(docs, min_length, min_documents, bits)
    texts = docs.select("doc_id", text_or_empty().alias("text"))
    joined = texts.join(lost, F.col("doc_id").eqNullSafe(F.col("loser")), "left").select("doc_id", "text", "lost")

    def rebuild(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, counts, drops = [], [], []
            for text, lost in zip(batch.column("text").to_pylist(), batch.column("lost").to_pylist()):
                lines = text.split("\n")
                counts.append(len(lines))
                if lost is not None:
                    gone = set(lost)
                    keys = line_keys(text, min_length)
                    lines = [line for line, key in zip(lines, keys) if key is None or digest(key) not in gone]
                    text = "\n".join(lines)
                texts.append(text)
                drops.append(counts[-1] - len(lines))
            columns = [batch.column("doc_id"), pa.array(texts, pa.string()), pa.array(counts, pa.int64()), pa.array(drops, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text", "n_lines", "n_dropped"])

    return joined.mapInArrow(rebuild, f"doc_id {kind}, text string, n_lines long, n_dropped long")
