"""MinHash near-deduplication by an inverted join over bands of signature coordinates."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.components import connected_components
from bitextloom.llm.shingles import mixed, multipliers, shared, shingle_set, signature
from bitextloom.llm.tables import broadcast_if_small, kept_rows, stored, text_digest, text_or_empty

WIDTH = 5
# Similarity in percent.
SIMILARITY = 80
# Bands of a signature that are posted, and coordinates of a band. At a similarity of 0.8 no band agrees once in 150,000 pairs; at 0.1
# one pair in 3,000 has a band in common, at 0.05 one in 100,000, so lists hold few texts that merely use the same words.
BANDS = 30
ROWS = 5
# The first coordinates, a byte each, that only colliding pairs compare, and the matches that they need. At a similarity of 0.8, fewer
# than 84 of 128 match once in 40,000 pairs; at 0.6 one pair in nine has as many, below 0.5 none.
SKETCH = 128
SKETCH_MATCHES = 84
SEED = 5
# Pivots of a list that its members are compared with, turn by turn, before its components are compared completely.
PIVOT_TURNS = (range(0, 1), range(1, 4))
# Shorter posting lists are joined with themselves; of longer ones a task compares so many members with as many others.
SHORT_LIST = 64
CHUNK = 1024
# Members whose sets a task of exact comparisons holds, twice.
PART = 2048


def document_features(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, digest of the text, n_shingles, digest of the set (null if empty), slots (hash and number of a band in one long each), sketch."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    factors = multipliers(BANDS * ROWS, SEED)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, signatures, sketches = [], [], [], []
            for text in batch.column("text").to_pylist():
                found = shingle_set(text, width)
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                least = signature(found, factors)
                signatures.append(band_slots(least) if len(found) else None)
                sketches.append(least[:SKETCH].astype(np.uint8).tobytes() if len(found) else None)
            kinds = (pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.binary())
            columns = [pa.array(c, k) for c, k in zip((sizes, digests, signatures, sketches), kinds)]
            given = [batch.column("doc_id"), batch.column("text_digest")]
            yield pa.RecordBatch.from_arrays([*given, *columns], ["doc_id", "text_digest", "n_shingles", "digest", "sig", "sketch"])

    texts = docs.select("doc_id", text_or_empty().alias("text"), text_digest().alias("text_digest"))
    return texts.mapInArrow(features, f"doc_id {kind}, text_digest binary, n_shingles long, digest binary, sig array<long>, sketch binary")


def band_slots(least: np.ndarray) -> np.ndarray:
    """One long for each band: a hash of its coordinates, and its number in the low bits."""
    bands, slots = least[: BANDS * ROWS].reshape(BANDS, ROWS), np.zeros(BANDS, np.uint64)
    for column in bands.T:
        slots = mixed(slots * np.uint64(0x9E3779B97F4A7C15) + column)
    return ((slots << np.uint64(5)) | np.arange(BANDS, dtype=np.uint64)).view(np.int64)


def posting_lists(classes: DataFrame) -> DataFrame:
    """slot, rep and weight (the lengths of all lists of rep).

    Slots that one class alone has, which are nearly all, are left out; they hold no pair.
    """
    slots = classes.select("rep", F.explode("sig").alias("slot"))
    lengths = slots.groupBy("slot").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    own = slots.join(lengths, "slot").groupBy("rep").agg(F.collect_list("slot").alias("own"), F.sum("n").alias("weight"))
    return own.select("rep", "weight", F.explode("own").alias("slot"))


def agreeing_pairs(pairs: DataFrame, classes: DataFrame, similarity: int) -> DataFrame:
    """Of the pairs (a, b) those whose sketches agree often enough, and whose sets are not too different in size."""
    pairs = stored(pairs.select("a", "b").distinct(), "pairs")
    met = stored(pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "pair-members")
    held = classes.join(broadcast_if_small(met), "rep", "left_semi")
    sides = [held.select(F.col("rep").alias(s), F.col("n_shingles").alias(f"n_{s}"), F.col("sketch").alias(f"sketch_{s}")) for s in "ab"]
    near = (
        pairs.join(sides[0], "a").join(sides[1], "b")
        .filter(100 * F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b"))
        .select("a", "b", "sketch_a", "sketch_b")
    )

    def agreeing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(f"sketch_{s}").to_pylist()), np.uint8).reshape(-1, SKETCH) for s in "ab")
            yield batch.select(["a", "b"]).filter(pa.array((x == y).sum(axis=1) >= SKETCH_MATCHES, pa.bool_()))

    return near.mapInArrow(agreeing, "a long, b long")


def sets_by_rep(held: pd.DataFrame) -> dict[int, list[np.ndarray]]:
    """Rows that share a doc_id have several sets; a pair is linked by any of them."""
    found: dict[int, list[np.ndarray]] = {}
    for rep, packed in zip(held["rep"], held["shingles"]):
        found.setdefault(rep, []).append(np.frombuffer(packed, np.uint64))
    return found


def any_similar(left: list[np.ndarray], right: list[np.ndarray], similarity: int) -> bool:
    for x in left:
        for y in right:
            common = shared(x, y)
            if 100 * common >= similarity * (len(x) + len(y) - common):
                return True
    return False


def verified(near: DataFrame, docs: DataFrame, width: int, similarity: int) -> DataFrame | None:
    """Of the pairs (a, b) those whose whole sets are similar enough; None if there are none.

    Sets are built again from the texts, for the members of the pairs alone. Members are dealt into parts, and the pairs of two parts are
    compared in one task, to which each of its members' sets goes once, in however many of the pairs it is.
    """
    near = stored(near.distinct(), "near-pairs")
    members = stored(near.select(F.explode(F.array("a", "b")).alias("rep")).distinct(), "near-members")
    count = members.count()
    if not count:
        return None
    parts = -(-count // PART)
    i, j = (F.pmod(F.xxhash64(side), F.lit(parts)).cast("int") for side in "ab")
    dealt = stored(near.select("a", "b", i.alias("i"), j.alias("j")), "dealt-pairs")
    wanted = dealt.select(F.col("i").alias("x"), F.col("j").alias("y"), F.explode(F.array("a", "b")).alias("rep")).distinct()
    sets = wanted.join(shingle_sets(docs, members, width), "rep").select("x", "y", "rep", "shingles")

    def compare(pairs: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        found = sets_by_rep(held)
        keep = [any_similar(found[a], found[b], similarity) for a, b in zip(pairs["a"], pairs["b"])]
        return pairs.loc[np.array(keep, bool), ["a", "b"]]

    links = dealt.groupBy("i", "j").cogroup(sets.groupBy("x", "y")).applyInPandas(compare, "a long, b long")
    links = stored(links, "near-links")
    return None if links.isEmpty() else links


def shingle_sets(docs: DataFrame, reps: DataFrame, width: int) -> DataFrame:
    """rep and its sorted shingle hashes, packed, for the documents named in `reps`."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [shingle_set(text, width).tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), pa.array(packed, pa.binary())], ["rep", "shingles"])

    texts = docs.select(F.col("doc_id").cast("long").alias("rep"), text_or_empty().alias("text"))
    return stored(texts.join(broadcast_if_small(reps), "rep", "left_semi").mapInArrow(build, "rep long, shingles binary"), "shingle-sets")


def pivot_pairs(lists: DataFrame, turn: range) -> DataFrame:
    """Pairs of members with members of their list that are in another component: pivot 0 is the list's most
    typical member, the others are drawn by a hash."""
    several = lists.groupBy("slot").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    live = lists.join(several.select("slot"), "slot")
    drawn = [F.col("weight") if i == 0 else F.xxhash64("rep", F.lit(i)) for i in turn]
    picks = [F.max(F.struct(rank.alias("rank"), "rep", "root")).alias(f"p{i}") for i, rank in zip(turn, drawn)]
    pivots = live.groupBy("slot").agg(*picks)
    every = F.array(*(F.struct(F.col(f"p{i}.rep").alias("rep"), F.col(f"p{i}.root").alias("root")) for i in turn))
    joined = live.select("slot", "rep", "root").join(pivots, "slot")
    other = F.explode(F.filter(every, lambda p: p["root"] != F.col("root")))
    pairs = joined.select("rep", other.alias("p"))
    return pairs.select(F.least("rep", "p.rep").alias("a"), F.greatest("rep", "p.rep").alias("b"))


def list_sides(frame: pd.DataFrame, i: int, j: int) -> tuple[pd.DataFrame, pd.DataFrame]:
    """The members of chunks i and j of a list, one frame twice if they are the same."""
    left = frame[frame["mine"] == i]
    return left, left if i == j else frame[frame["mine"] == j]


def agreeing_members(left: pd.DataFrame, right: pd.DataFrame, slot: int, similarity: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row of left, rows of right) of the pairs of different components whose sketches agree often enough, each from one list
    only: the first band that both have in common owns a pair."""
    if not len(left) or not len(right):
        return
    band = int(slot) & 31
    sig_r, n_r = np.stack(right["sig"].to_numpy()), right["n_shingles"].to_numpy()
    rep_r, root_r = right["rep"].to_numpy(), right["root"].to_numpy()
    sketches = np.frombuffer(b"".join(right["sketch"]), np.uint8).reshape(-1, SKETCH)
    for at, (rep, root, n, sig, sketch) in enumerate(zip(*(left[c] for c in ("rep", "root", "n_shingles", "sig", "sketch")))):
        good = (root_r != root) & (100 * np.minimum(n, n_r) >= similarity * np.maximum(n, n_r))
        good &= ~(sig_r[:, :band] == sig[None, :band]).any(axis=1)
        if left is right:
            good &= rep_r > rep
        hit = np.flatnonzero(good)
        hit = hit[(sketches[hit] == np.frombuffer(sketch, np.uint8)).sum(axis=1) >= SKETCH_MATCHES]
        if len(hit):
            yield at, hit


def long_list_links(rows: DataFrame, docs: DataFrame, width: int, similarity: int) -> DataFrame:
    """Links (a, b) that connect what the similar pairs of long lists connect; no pair leaves the task that compares it.

    `rows` are the members dealt to pairs of chunks. A first pass finds by sketches which members of two chunks are in any pair; the second gets
    these with their sets, and links a pair if its sets are similar and no earlier links of the task have connected it. So a
    pair of chunks gives fewer rows than it has members, however many of their pairs nearly are similar.
    """
    rows = stored(rows, "dealt-members")

    def meeting(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        slot, i, j = key
        left, right = list_sides(frame, i, j)
        in_left, in_right = np.zeros(len(left), bool), np.zeros(len(right), bool)
        for at, hit in agreeing_members(left, right, slot, similarity):
            in_left[at] = in_right[hit] = True
        reps = np.unique(np.concatenate([left["rep"].to_numpy()[in_left], right["rep"].to_numpy()[in_right]]))
        return pd.DataFrame({"slot": slot, "i": i, "j": j, "rep": reps}).astype({"rep": "int64"})

    met = rows.groupBy("slot", "i", "j").applyInPandas(meeting, "slot long, i int, j int, rep long")
    met = stored(met, "met-members")
    sets = met.join(shingle_sets(docs, stored(met.select("rep").distinct(), "met"), width), "rep")
    live = rows.join(met, ["slot", "i", "j", "rep"], "left_semi")

    def connect(key: tuple, frame: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        slot, i, j = key
        left, right = list_sides(frame, i, j)
        found, top = sets_by_rep(held), {}

        def highest(root: int) -> int:
            while top.setdefault(root, root) != root:
                top[root] = top[top[root]]
                root = top[root]
            return root

        ends = [(side["rep"].to_numpy(), side["root"].to_numpy()) for side in (left, right)]
        links = []
        for at, hit in agreeing_members(left, right, slot, similarity):
            a = ends[0][0][at]
            for b, beyond in zip(ends[1][0][hit], ends[1][1][hit]):
                root, other = highest(ends[0][1][at]), highest(beyond)
                if root != other and any_similar(found[a], found[b], similarity):
                    top[other] = root
                    links.append((min(a, b), max(a, b)))
        return pd.DataFrame(links, columns=["a", "b"], dtype="int64")

    linked = live.groupBy("slot", "i", "j").cogroup(sets.groupBy("slot", "i", "j")).applyInPandas(connect, "a long, b long")
    return stored(linked, "long-links")


def crossing_links(lists: DataFrame, classes: DataFrame, docs: DataFrame, width: int, similarity: int) -> DataFrame | None:
    """Links (a, b) that connect what all similar pairs of different components in a common list connect; None if there are none.

    Only lists with several components are dealt. Short ones are joined with themselves. Longer ones are dealt in
    chunks: a task compares one chunk with another.
    """
    mixed = lists.groupBy("slot").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n"))
    mixed = stored(mixed.filter("low <> high").select("slot", "n", F.ceil(F.col("n") / CHUNK).cast("int").alias("chunks")), "mixed")
    short = lists.join(mixed.filter(F.col("n") <= SHORT_LIST), "slot")
    sides = [short.select("slot", F.col("rep").alias(s), F.col("root").alias(f"root_{s}")) for s in "ab"]
    joined = sides[0].join(sides[1], "slot").filter("a < b and root_a <> root_b").select("a", "b")
    rows = lists.select("slot", "rep", "root").join(mixed.filter(F.col("n") > SHORT_LIST).drop("n"), "slot")
    rows = rows.join(classes.select("rep", "n_shingles", "sig", "sketch"), "rep")
    chunk = F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int")
    rows = rows.withColumn("mine", chunk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("slot", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "root", "n_shingles", "sig", "sketch")
    links = verified(agreeing_pairs(joined, classes, similarity), docs, width, similarity)
    if mixed.filter(F.col("n") > SHORT_LIST).isEmpty():
        return links
    more = long_list_links(rows, docs, width, similarity)
    if links is None:
        return None if more.isEmpty() else more
    return links.select("a", "b").union(more).distinct()


def merged_roots(roots: DataFrame | None, links: DataFrame) -> DataFrame:
    """rep and root (the smallest rep of its component) of every rep that has been linked, after some more links.

    Only links between different roots are contracted, so a late turn costs as little as it adds.
    """
    reps = links.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    if roots is None:
        roots = reps.withColumn("root", F.col("rep"))
        between = links
    else:
        roots = stored(roots.union(reps.join(roots, "rep", "left_anti").withColumn("root", F.col("rep"))), "all-roots")
        ends = [roots.select(F.col("rep").alias(s), F.col("root").alias(f"root_{s}")) for s in "ab"]
        between = links.join(ends[0], "a").join(ends[1], "b").select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))
    moved = connected_components(between).select(F.col("node").alias("root"), F.col("component").alias("found"))
    return stored(roots.join(moved, "root", "left").select("rep", F.coalesce("found", "root").alias("root")), "roots")


def with_roots(lists: DataFrame, roots: DataFrame) -> DataFrame:
    """`lists` with the component of each member so far."""
    found = broadcast_if_small(roots.withColumnRenamed("root", "found"))
    return stored(lists.drop("root").join(found, "rep", "left").withColumn("root", F.coalesce("found", "rep")).drop("found"), "lists")


def near_roots(docs: DataFrame, classes: DataFrame, width: int, similarity: int) -> DataFrame | None:
    """`merged_roots` over links of classes whose components are those of all similar pairs; None if there is no link.

    Members are compared with a list's most typical member first, then with three more; what is one component by then needs no
    other link. Lists that still hold several components
    have all their crossing pairs compared, so no component is missed, and a large group of near copies costs a
    few comparisons for each copy.
    """
    lists, roots = stored(posting_lists(classes).withColumn("root", F.col("rep")), "lists"), None
    for turn in (*PIVOT_TURNS, None):
        crossing = turn is None
        if crossing:
            links = crossing_links(lists, classes, docs, width, similarity)
        else:
            links = verified(agreeing_pairs(pivot_pairs(lists, turn), classes, similarity), docs, width, similarity)
        if links is not None:
            roots = merged_roots(roots, links)
            if not crossing:
                lists = with_roots(lists, roots)
    return roots


def near_groups(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, kept.

    Texts with equal shingle sets are one class from the start. Null and empty texts and texts without words have
    an empty set and are linked with nothing. Rows without a doc_id are linked with nothing either and stay, with
    a null component_id. Rows that share a doc_id are one document for links.
    """
    return row_groups(docs, width, similarity).drop("text_digest")


def row_groups(docs: DataFrame, width: int, similarity: int) -> DataFrame:
    """`near_groups` with the digest of each row's text."""
    features = stored(document_features(docs, width), "features")
    classes = stored(
        features.filter("digest is not null and doc_id is not null")
        .groupBy("digest")
        .agg(F.min("doc_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch")),
        "classes",
    )
    roots = near_roots(docs, classes, width, similarity)
    named = classes.select("digest", "rep", "copies").withColumn("component", F.lit(None).cast("long"))
    if roots is not None:
        named = named.drop("component").join(roots.withColumnRenamed("root", "component"), "rep", "left")
    named = named.filter("copies > 1 or component is not null").select("digest", F.coalesce("component", "rep").alias("component"))
    joined = features.select("doc_id", "text_digest", "n_shingles", "digest").join(broadcast_if_small(stored(named, "named")), "digest", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", F.col("doc_id").cast("long")))
    return joined.select("doc_id", "text_digest", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )


def drop_near_copies(docs: DataFrame, width: int = WIDTH, similarity: int = SIMILARITY) -> DataFrame:
    """`docs` with one document of each group of near copies, that with the smallest doc_id, by doc_id and text.

    Rows without a doc_id, and texts without words, stay; of rows equal in doc_id and text any one does.
    """
    decided = row_groups(docs, width, similarity).select("doc_id", F.col("text_digest").alias("digest"), "kept")
    return kept_rows(docs, stored(decided, "near-decided"))
