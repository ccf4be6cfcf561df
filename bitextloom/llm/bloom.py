"""A pair of Bloom filters, once-seen and twice-seen, built by tasks and merged by segment."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# Bits of a segment, the unit in which tasks send their filters.
SEGMENT_BITS = 1 << 16
# Segments that are packed at a time.
BLOCK = 64
# Places that repeated hashes are told apart by, dealt in slabs. Only what tasks send has this size, no filter has.
PLACE_BITS = 34
SLAB_BITS = 24
# Hashes that a task holds before it sends them.
HELD = 1 << 22
# A sparser part is sent as positions, a denser one as bits.
SPARSE = 4096
SCHEMA = "segment int, once binary, twice binary"


def positions(hashes: np.ndarray, bits: int, probes: int) -> np.ndarray:
    """Bit positions, one row per probe; `bits` is a power of two."""
    hashes = hashes.astype(np.uint64, copy=False)
    step = (hashes >> np.uint64(32)) | np.uint64(1)
    probe = np.arange(probes, dtype=np.uint64)[:, None]
    return ((hashes[None, :] + probe * step[None, :]) & np.uint64(bits - 1)).astype(np.int64)


class PairFilter:
    """Bits set by one item or more (once) and by two or more (twice).

    An item is surely in `twice` once it was added twice, here or in two merged filters. Other items may be
    too, which costs work and changes no result.
    """

    def __init__(self, bits: int, probes: int) -> None:
        self.bits, self.probes = bits, probes
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        at = np.sort(positions(hashes, self.bits, self.probes).ravel())
        again = at[1:] == at[:-1]
        seen = lookup(self.once, at)
        seen[1:] |= again
        mark(self.twice, at[seen])
        mark(self.once, at[np.concatenate([[True], ~again])])

    def segments(self) -> Iterator[tuple[int, bytes, bytes]]:
        length = min(self.bits, SEGMENT_BITS) // 8
        for start in range(0, self.bits // 8, BLOCK * length):
            parts = [packs(filled[start : start + BLOCK * length], length) for filled in (self.once, self.twice)]
            for segment, (once, twice) in enumerate(zip(*parts), start // length):
                if once:
                    yield segment, once, twice


def lookup(packed: np.ndarray, at: np.ndarray) -> np.ndarray:
    return packed[at >> 3] & (np.uint8(128) >> (at & 7).astype(np.uint8)) != 0


def mark(packed: np.ndarray, at: np.ndarray) -> None:
    """Set sorted positions, the bits of one byte together."""
    if len(at):
        byte = at >> 3
        first = np.flatnonzero(np.diff(byte, prepend=-1))
        packed[byte[first]] |= np.bitwise_or.reduceat(np.uint8(128) >> (at & 7).astype(np.uint8), first)


def pack(part: np.ndarray) -> bytes:
    """`packs` of one segment."""
    return packs(part, len(part))[0]


def packs(block: np.ndarray, length: int) -> list[bytes]:
    """Of each segment of `length` bytes set positions as 16-bit numbers if they are few, else the bits; the length tells which."""
    filled = np.flatnonzero(block)
    which, bit = np.nonzero(np.unpackbits(block[filled][:, None], axis=1))
    at = filled[which] * 8 + bit
    ends = np.searchsorted(at, np.arange(0, len(block) + 1, length) * 8).tolist()
    places, out = (at % (8 * length)).astype("<u2"), []
    for k, (low, high) in enumerate(zip(ends, ends[1:])):
        few = high == low or 8 * length == SEGMENT_BITS and high - low < SPARSE
        out.append(places[low:high].tobytes() if few else block[k * length : (k + 1) * length].tobytes())
    return out


def unpack(data: bytes, length: int) -> np.ndarray:
    """Set positions."""
    if len(data) == length // 8:
        return np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8)))
    return np.frombuffer(data, "<u2").astype(np.int64)


def segment_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = (pa.int32(), pa.binary(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["segment", "once", "twice"])


def twice_seen(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int, probes: int = 4) -> np.ndarray:
    """The twice-seen filter over all hashes of `df`, packed: `bits` / 8 bytes, whatever the size of `df`.

    `hashes` gives the 64-bit hashes of a batch. Tasks send only what they set, segments are merged by
    tasks of their own, and the merged bits come to the driver, which broadcasts them.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = PairFilter(bits, probes)
        for batch in batches:
            found = hashes(batch)
            if len(found):
                pair.add(found)
        rows: list[tuple[int, bytes, bytes]] = []
        for row in pair.segments():
            rows.append(row)
            if len(rows) == 256:
                yield segment_batch(rows)
                rows = []
        yield segment_batch(rows)

    length = min(bits, SEGMENT_BITS)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for segment, once, twice in zip(*(batch.column(i).to_pylist() for i in range(3))):
                mine = parts.setdefault(segment, (np.zeros(length, bool), np.zeros(length, bool)))
                at = unpack(once, length)
                mine[1][at[mine[0][at]]] = True
                mine[0][at] = True
                mine[1][unpack(twice, length)] = True
        rows = [(s, b"", np.packbits(twice).tobytes()) for s, (_, twice) in parts.items() if twice.any()]
        yield segment_batch(rows)

    merged = df.mapInArrow(build, SCHEMA).repartition("segment").mapInArrow(merge, SCHEMA)
    return collected(merged, bits)


def collected(merged: DataFrame, bits: int) -> np.ndarray:
    """A packed filter from the bits of its segments."""
    length, packed = min(bits, SEGMENT_BITS), np.zeros(bits // 8, np.uint8)
    for row in merged.select("segment", "twice").collect():
        start = row["segment"] * length // 8
        packed[start : start + length // 8] = np.frombuffer(row["twice"], np.uint8)
    return packed


def slabs(places: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Sorted places by slab: how many are in each of its stretches of 2^16, and where in these they are."""
    inner, ends = 1 << (SLAB_BITS - 16), np.searchsorted(places, np.arange((1 << (PLACE_BITS - SLAB_BITS)) + 1) << SLAB_BITS).tolist()
    for slab, (low, high) in enumerate(zip(ends, ends[1:])):
        if low < high:
            part = places[low:high] & ((1 << SLAB_BITS) - 1)
            counts = np.bincount(part >> 16, minlength=inner).astype("<u4")
            yield slab, counts.tobytes() + (part & 0xFFFF).astype("<u2").tobytes()


def slab_places(data: bytes) -> np.ndarray:
    """Places within a slab."""
    inner = 1 << (SLAB_BITS - 16)
    counts = np.frombuffer(data, "<u4", inner)
    return (np.repeat(np.arange(inner, dtype=np.int64), counts) << 16) + np.frombuffer(data, "<u2", offset=4 * inner)


def repeated_filter(df: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], bits: int) -> np.ndarray:
    """As `twice_seen` with one probe, but filled by the repeated hashes alone, however many others there are.

    Two different hashes are taken for one only where they agree in PLACE_BITS bits: their places meet in tasks that have a slab of
    all places each, and what is there twice is marked in a filter of `bits` bits. Tasks send two bytes for a hash.
    """
    length = min(bits, SEGMENT_BITS)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def sent(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            rows = list(slabs(np.sort(np.concatenate(parts) & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)))
            for at in range(0, len(rows), 256):
                columns = zip(*rows[at : at + 256])
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.binary()))], ["slab", "places"])

        parts, count = [], 0
        for batch in batches:
            parts.append(hashes(batch))
            count += len(parts[-1])
            if count >= HELD:
                yield from sent(parts)
                parts, count = [], 0
        if parts:
            yield from sent(parts)

    def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, list[bytes]] = {}
        for batch in batches:
            for slab, places in zip(batch.column("slab").to_pylist(), batch.column("places").to_pylist()):
                parts.setdefault(slab, []).append(places)
        for slab in list(parts):
            places = np.sort(np.concatenate([slab_places(data) for data in parts.pop(slab)]))
            at = np.unique(((slab << SLAB_BITS) + places[1:][places[1:] == places[:-1]]) & (bits - 1))
            firsts = np.flatnonzero(np.diff(at // length, prepend=-1))
            rows = []
            for low, high in zip(firsts, np.append(firsts[1:], len(at))):
                part = at[low:high] % length
                few = length == SEGMENT_BITS and len(part) < SPARSE
                data = part.astype("<u2") if few else np.packbits(np.isin(np.arange(length), part))
                rows.append((int(at[low]) // length, b"", data.tobytes()))
            for k in range(0, len(rows), 256):
                yield segment_batch(rows[k : k + 256])

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, twice in zip(batch.column("segment").to_pylist(), batch.column("twice").to_pylist()):
                parts.setdefault(segment, np.zeros(length, bool))[unpack(twice, length)] = True
        yield segment_batch([(s, b"", np.packbits(twice).tobytes()) for s, twice in parts.items()])

    found = df.mapInArrow(build, "slab int, places binary").repartition("slab").mapInArrow(repeated, SCHEMA)
    return collected(found.repartition("segment").mapInArrow(united, SCHEMA), bits)


def suspected(packed: np.ndarray, hashes: np.ndarray, probes: int = 4) -> np.ndarray:
    """Whether each hash may have been added twice."""
    at = positions(hashes, len(packed) * 8, probes)
    return lookup(packed, at).all(axis=0)
