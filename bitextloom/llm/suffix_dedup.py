"""Removal of byte strings that start in several places: suffixes around shared anchors, sorted deep and shallow."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.suffix_sort import deep_shallow
from bitextloom.llm.tables import broadcast_if_small, stored, text_or_empty
from bitextloom.llm.winnowing import PIECE, anchors

WINDOW = 400
# Contexts of one anchor that a task sorts; those of more are counted by what their windows hold.
LIMIT = 4096
# Windows that are counted together before each is counted alone.
BAND = 32
# Elements of the tables that compare the members of a group.
CELLS = 1 << 19
SPAN_ROWS = 200_000
CONTEXT = "gram long, digest binary, first long, windows long, offset long, known boolean, context binary"
RUN = "digest binary, first long, windows long"
SPANS = "array<struct<start: long, end: long>>"


def name(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def merged(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted unions of [start, end) that overlap or touch."""
    out: list[list[int]] = []
    for start, end in sorted(runs):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(run) for run in out]


def binary_parts(column: pa.BinaryArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, starts) of consecutive rows of a column without nulls, about PIECE bytes at a time, nothing copied."""
    _, offsets, data = column.buffers()
    starts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        after = max(row + 1, int(np.searchsorted(starts, starts[row] + PIECE, "right")) - 1)
        after = min(after, len(column))
        yield row, held[starts[row] : starts[after]], starts[row : after + 1] - starts[row]
        row = after


def repeated_windows(members: list[tuple[bytes, int, int]], window: int) -> list[list[tuple[int, int]]]:
    """For each member (context, windows, offset of the anchor in it) the runs (first window, windows) that another one holds.

    All members have one anchor. Two windows are equal if they have the anchor in the same place, o, and the members
    agree for o bytes before the anchor and window - o bytes from it on. Sorted suffixes from the anchor on, and sorted prefixes before
    it read backwards, give classes of members that agree so far: neighbours with a common prefix that long.
    """
    count = len(members)
    first = np.array([offset - windows + 1 for _, windows, offset in members])
    last = np.array([offset for _, _, offset in members])
    sides = [deep_shallow([c[offset:] for c, _, offset in members]), deep_shallow([c[:offset][::-1] for c, _, offset in members])]
    orders = [np.array(order) for order, _ in sides]
    agree = [np.array(shared) for _, shared in sides]
    out: list[list[tuple[int, int]]] = [[] for _ in members]
    step = max(1, CELLS // count)
    for low in range(int(first.min()), int(last.max()) + 1, step):
        places = np.arange(low, min(low + step, int(last.max()) + 1))[:, None]
        both = np.zeros((len(places), count), np.int64)
        for order, shared, needed in zip(orders, agree, (window - places, places)):
            classes = np.cumsum(shared[None, :] < needed, axis=1)
            placed = np.empty_like(classes)
            placed[:, order] = classes
            both = both * (count + 1) + placed
        inside = (places >= first) & (places <= last)
        both = np.where(inside, both, -1 - np.arange(count))
        ranks = np.argsort(both, axis=1, kind="stable")
        ranked = np.take_along_axis(both, ranks, axis=1)
        same = ranked[:, 1:] == ranked[:, :-1]
        twice = np.zeros_like(both, bool)
        twice[:, 1:] |= same
        twice[:, :-1] |= same
        flags = np.zeros_like(twice)
        np.put_along_axis(flags, ranks, twice, axis=1)
        for member in np.flatnonzero(flags.any(axis=0)).tolist():
            held = np.flatnonzero(np.diff(flags[:, member].astype(np.int8), prepend=0, append=0))
            for begin, end in zip(held[::2].tolist(), held[1::2].tolist()):
                # A window starts as many bytes before the anchor as its place says.
                out[member].append((int(last[member]) - (low + end - 1), end - begin))
    return out


class RepeatedBytes:
    """The passes over one table of texts; equal texts are one from the start."""

    def __init__(self, docs: DataFrame, window: int, limit: int) -> None:
        self.window, self.limit = window, limit
        self.texts = docs.select("doc_id", text_or_empty().cast("binary").alias("text"))
        self.texts = self.texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
        self.sizes = stored(self.texts.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")), "text-sizes")
        long = self.sizes.filter(F.col("n_bytes") >= window)
        copies = long.groupBy("digest").agg(F.min("doc_id").alias("rep"), F.max("n_bytes").alias("end"), F.count(F.lit(1)).alias("copies"))
        self.copies = stored(copies.filter("copies > 1").select("digest", "rep", "end"), "text-copies")
        joined = self.texts.filter(F.octet_length("text") >= window).join(broadcast_if_small(self.copies), "digest", "left")
        self.reps = joined.filter(F.col("end").isNull() | F.col("doc_id").eqNullSafe(F.col("rep"))).select("digest", "text")

    def anchors(self) -> DataFrame:
        """Contexts of anchors: the bytes of all windows that choose one gram, by gram, name, and place in their text.

        kind 0: one row for each distinct context of a part of the texts, `known` if that part holds it again; kind 1: the merged runs of
        windows of contexts that a part holds again.
        """
        window = self.window

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = (pa.int32(), pa.binary(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_())
            names = ["kind", "digest", "gram", "name", "first", "windows", "offset", "known"]
            for batch in batches:
                digests = batch.column("digest").to_pylist()
                for row, data, starts in binary_parts(batch.column("text")):
                    found = anchors(data, starts, window)
                    held = data.tobytes()
                    texts = np.searchsorted(starts, found.first, "right") - 1
                    grams, firsts, counts, places = (column.tolist() for column in (found.gram.astype(np.int64), *found[1:]))
                    known: dict[bytes, list[int]] = {}
                    for i, (first, windows) in enumerate(zip(firsts, counts)):
                        known.setdefault(name(held[first : first + windows + window - 1]), []).append(i)
                    out, runs, begins = [], {}, starts[texts].tolist()
                    texts = texts.tolist()
                    for context, own in known.items():
                        i = own[0]
                        out.append((0, digests[row + texts[i]], grams[i], context, firsts[i] - begins[i], counts[i], places[i] - firsts[i], len(own) > 1))
                        if len(own) > 1:
                            for j in own:
                                start = firsts[j] - begins[j]
                                runs.setdefault(texts[j], []).append((start, start + counts[j]))
                    for text, own in runs.items():
                        out += [(1, digests[row + text], None, None, a, b - a, None, True) for a, b in merged(own)]
                    columns = list(zip(*out)) or [()] * 8
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        schema = "kind int, digest binary, gram long, name binary, first long, windows long, offset long, known boolean"
        return stored(self.reps.select("digest", "text").mapInArrow(build, schema), "anchors")

    def runs(self) -> DataFrame:
        """digest, first, windows: runs of windows whose bytes are elsewhere too, of the texts that no other text equals."""
        found = self.anchors()
        single = found.filter("kind = 0")
        grams = single.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.min("name").alias("low"), F.max("name").alias("high"))
        grams = stored(grams.filter("n > 1").select("gram", (F.col("low") != F.col("high")).alias("mixed")), "shared-grams")
        shared = stored(single.join(broadcast_if_small(grams), "gram"), "shared-anchors")
        place = F.struct("digest", "first", "windows", "offset")
        contexts = shared.filter("mixed").groupBy("gram", "name").agg(
            F.min(place).alias("place"), F.count(F.lit(1)).alias("n"), F.max("known").alias("known")
        )
        contexts = stored(contexts.select("gram", "name", "place.*", "n", (F.col("known") | (F.col("n") > 1)).alias("known")), "contexts")
        several = contexts.filter("n > 1").select("gram", "name")
        run = ["digest", "first", "windows"]
        equal = shared.filter("mixed").join(broadcast_if_small(several), ["gram", "name"], "left_semi")
        runs = [found.filter("kind = 1").select(*run), shared.filter("not mixed").select(*run), equal.select(*run)]
        many = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("members")).filter(F.col("members") > self.limit)
        many = stored(many.select("gram"), "many-contexts")
        usual = contexts.join(broadcast_if_small(many), "gram", "left_anti")
        runs.append(self.sorted_runs(usual))
        if not many.isEmpty():
            runs.append(self.counted_runs(contexts.join(broadcast_if_small(many), "gram", "left_semi")))
        every = runs[0]
        for more in runs[1:]:
            every = every.union(more)
        return every

    def fetched(self, contexts: DataFrame) -> DataFrame:
        """`CONTEXT` of the contexts asked for: their bytes, cut from the texts."""
        window = self.window
        wanted = F.collect_list(F.struct("gram", "first", "windows", "offset", "known")).alias("wanted")
        asked = stored(contexts.groupBy("digest").agg(wanted), "asked-contexts")
        texts = self.reps.join(broadcast_if_small(asked, SPAN_ROWS), "digest").select("digest", "text", "wanted")

        def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
            names = [part.split()[0] for part in CONTEXT.split(", ")]
            for batch in batches:
                for i in range(len(batch)):
                    digest, text, wanted = (batch.column(c)[i].as_py() for c in range(3))
                    out = [(w["gram"], digest, w["first"], w["windows"], w["offset"], w["known"], text[w["first"] : w["first"] + w["windows"] + window - 1]) for w in wanted]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

        return texts.mapInArrow(cut, CONTEXT)

    def sorted_runs(self, contexts: DataFrame) -> DataFrame:
        """Runs by sorting the suffixes of each anchor's contexts, of which a task holds one anchor's at a time."""
        window = self.window
        dealt = self.fetched(contexts).repartition("gram").sortWithinPartitions("gram")

        def finish(group: list[tuple]) -> list[tuple]:
            # Texts are cut at the ends of a pass: contexts of one anchor may be equal but for where they are cut.
            found = repeated_windows([(context, windows, offset) for _, _, _, windows, offset, _, context in group], window)
            return [(m[1], m[2] + first, windows) for m, own in zip(group, found) if not m[5] for first, windows in own]

        def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            group: list[tuple] = []
            for batch in batches:
                out = []
                for member in zip(*(batch.column(c).to_pylist() for c in range(batch.num_columns))):
                    if group and group[0][0] != member[0]:
                        out += finish(group)
                        group = []
                    group.append(member)
                yield run_batch(out)
            yield run_batch(finish(group) if group else [])

        return stored(dealt.mapInArrow(sort, RUN), "sorted-runs")

    def counted_runs(self, contexts: DataFrame) -> DataFrame:
        """Runs of anchors with so many contexts that no task may hold them: windows named by their bytes and counted.

        What all windows of a band of places have in common is counted first, so that only bands shared by
        several contexts are taken apart. Counts are combined before they are shuffled.
        """
        window = self.window
        held = stored(self.fetched(contexts), "held-contexts")

        def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                out = []
                for gram, digest, first, windows, offset, _, context in zip(*(batch.column(c).to_pylist() for c in range(7))):
                    for band in range((offset - windows + 1) // BAND, offset // BAND + 1):
                        core = context[offset - band * BAND : offset - band * BAND + window - BAND + 1]
                        out.append((name(b"%d %d " % (gram, band) + core), digest, first, band))
                kinds = (pa.binary(), pa.binary(), pa.int64(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds)], ["core", "digest", "first", "band"])

        cores = stored(held.mapInArrow(bands, "core binary, digest binary, first long, band int"), "bands")
        twice = stored(cores.groupBy("core").count().filter("count > 1").select("core"), "shared-bands")
        live = cores.join(broadcast_if_small(twice), "core", "left_semi").groupBy("digest", "first").agg(F.collect_set("band").alias("bands"))
        taken = held.join(live, ["digest", "first"]).select("digest", "first", "windows", "offset", "context", "bands", "known")

        def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    out, context = [], row["context"]
                    for place in (p for band in sorted(row["bands"]) for p in range(band * BAND, band * BAND + BAND)):
                        at = row["offset"] - place
                        if 0 <= at < row["windows"]:
                            out.append((name(context[at : at + window]), row["digest"], row["first"] + at, row["known"]))
                    kinds = (pa.binary(), pa.binary(), pa.int64(), pa.bool_())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 4, kinds)], ["bytes", "digest", "first", "known"])

        single = stored(taken.mapInArrow(each, "bytes binary, digest binary, first long, known boolean"), "counted-windows")
        again = stored(single.groupBy("bytes").count().filter("count > 1").select("bytes"), "shared-windows")
        hit = single.filter("not known").join(broadcast_if_small(again), "bytes", "left_semi")
        return hit.select("digest", "first", F.lit(1).cast("long").alias("windows"))

    def spans(self) -> DataFrame:
        """digest and runs, the bytes that go as [start, end) that may overlap, of every text that loses any."""
        end = F.col("first") + F.col("windows") + (self.window - 1)
        covered = self.runs().join(broadcast_if_small(self.copies), "digest", "left_anti")
        runs = covered.groupBy("digest").agg(F.collect_list(F.struct(F.col("first").alias("start"), end.alias("end"))).alias("runs"))
        whole = F.array(F.struct(F.lit(0).cast("long").alias("start"), F.col("end")))
        return stored(runs.union(self.copies.select("digest", whole)), "spans")


def strip_repeats(docs: DataFrame, window: int = WINDOW, limit: int = LIMIT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, spans (the bytes removed, [start, end), in order), kept (the bytes left).

    A text is its UTF-8 bytes, null counts as empty. Each byte goes that lies in a string of `window` bytes which
    starts in another place too, in another document or in the same one, overlapping or not; strings are judged on the texts as given and
    never cross documents. Shorter texts stay whole. Of equal texts of `window` bytes or more nothing stays. Rows
    may share a doc_id or have none: each is a text of its own. Other columns are ignored; an empty table has no rows.

    Every window chooses one of its grams by content, so equal windows choose alike. Grams that are in one place only end there;
    contexts that are equal as a whole are repeated as a whole. What is left, different contexts of one gram,
    is sorted by suffix in tasks that hold one gram at a time, or, beyond `limit` contexts, counted window by window.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    work = RepeatedBytes(docs, window, limit)
    texts = work.texts.join(broadcast_if_small(work.spans(), SPAN_ROWS), "digest", "left").select("doc_id", "text", "runs")

    def strip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            texts, sizes, spans = batch.column("text").to_pylist(), [], []
            for i, runs in enumerate(batch.column("runs").to_pylist()):
                sizes.append(len(texts[i]))
                own = merged([(run["start"], run["end"]) for run in runs or ()])
                spans.append([{"start": a, "end": b} for a, b in own])
                if own:
                    edges = [0, *(edge for run in own for edge in run), len(texts[i])]
                    texts[i] = b"".join(texts[i][a:b] for a, b in zip(edges[::2], edges[1::2]))
            columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(texts, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    return texts.mapInArrow(strip, f"doc_id {kind}, n_bytes long, spans {SPANS}, kept binary")


def run_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.binary(), pa.int64(), pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 3, kinds)], ["digest", "first", "windows"])
