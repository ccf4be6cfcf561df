"""Embedding near-deduplication: chunks against chunks by the leading half of rotated dimensions, then exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.components import connected_components
from bitextloom.llm.tables import broadcast_if_small, stored

COSINE = 0.9
# Vectors that a task compares with as many others at a time, at most, and bytes of one such chunk in double precision.
CHUNK = 16384
CHUNK_BYTES = 8 << 20
TILE = 1024
# Share of near pairs from which a tile is decided as a whole.
DENSE = 0.02
SEED = 3
# What single precision may err by in a squared distance, and for each of its terms.
ROUGH_SLACK = 1e-5
TERM_SLACK = 2.4e-7


class Rotation:
    """A fixed random rotation, of which the leading half of the dimensions is taken: it holds about half of any squared distance,
    and never more than the whole."""

    def __init__(self, size: int, cosine: float) -> None:
        self.size, self.cosine, self.lead = size, cosine, -(-size // 2)
        self.matrix = np.linalg.qr(np.random.default_rng(SEED).normal(size=(size, size)))[0][:, : self.lead]
        # |x - y|^2 = 2 - 2 cos for unit vectors.
        self.least = np.float32(-(2 - 2 * cosine + ROUGH_SLACK + TERM_SLACK * (self.lead + 2)) / 2)

    def rough(self, vectors: np.ndarray, other: bool = False) -> np.ndarray:
        """Rows whose products with the other side's are minus half the squared distances in the leading dimensions."""
        x = vectors @ self.matrix
        half, one = -(x * x).sum(axis=1, keepdims=True) / 2, np.ones((len(x), 1))
        return np.hstack([x, one, half] if other else [x, half, one]).astype(np.float32)


def unit(packed: list[bytes], size: int) -> np.ndarray:
    """Unit vectors in double precision; the largest component is taken out first, so huge and tiny ones stay finite."""
    kind = np.float32 if len(packed[0]) == 4 * size else np.float64
    vectors = np.frombuffer(b"".join(packed), kind).reshape(len(packed), size).astype(np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def read_vectors(vectors: DataFrame) -> DataFrame:
    """vec_id, size, vector (packed components), null where the embedding is null, empty, zero, or has null or non-finite ones."""
    kind = vectors.schema["vec_id"].dataType.simpleString()
    single = vectors.schema["embedding"].dataType.elementType.simpleString() == "float"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed, sizes = [], []
            for values in batch.column("embedding").to_pylist():
                good = values is not None and len(values) > 0 and None not in values
                vector = np.array(values, np.float32 if single else np.float64) if good else np.zeros(0)
                good = good and bool(np.isfinite(vector).all()) and bool(vector.any())
                # Adding 0 makes one zero of two, so equal vectors have equal bytes.
                packed.append((vector + 0).tobytes() if good else None)
                sizes.append(len(vector))
            columns = [batch.column("vec_id"), pa.array(sizes, pa.int32()), pa.array(packed, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "size", "vector"])

    return stored(vectors.select("vec_id", "embedding").mapInArrow(pack, f"vec_id {kind}, size int, vector binary"), "vectors")


def tile_links(left: pd.DataFrame, right: pd.DataFrame, rotation: Rotation, same: bool):
    """(rows of left, rows of right) of all links, tile by tile.

    One product in single precision finds the pairs that are near in the leading dimensions; the few it leaves, or all of a
    crowded tile, are decided in double precision.
    """
    a_unit = unit(left["vector"].tolist(), rotation.size)
    b_unit = a_unit if same else unit(right["vector"].tolist(), rotation.size)
    rough_a, rough_b = rotation.rough(a_unit), rotation.rough(b_unit, other=True)
    for i in range(0, len(left), TILE):
        for j in range(i if same else 0, len(right), TILE):
            near = rough_a[i : i + TILE] @ rough_b[j : j + TILE].T >= rotation.least
            if same and i == j:
                near = np.triu(near, 1)
            at = np.flatnonzero(near)
            if len(at) > DENSE * near.size:
                near &= a_unit[i : i + TILE] @ b_unit[j : j + TILE].T >= rotation.cosine
                r, c = np.nonzero(near)
            else:
                r, c = np.divmod(at, near.shape[1])
                exact = np.einsum("ij,ij->i", a_unit[r + i], b_unit[c + j]) >= rotation.cosine
                r, c = r[exact], c[exact]
            if len(r):
                yield r + i, c + j


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links enough to connect what the links a-b connect: fewer than vectors."""
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    kept = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = top(x), top(y)
        if p != q:
            parent[p] = q
            kept.append((x, y))
    return kept


def vector_links(classes: DataFrame, cosine: float) -> DataFrame:
    """Partial results of all pairs of chunks: (a, null, n): a has n more links; (a, b, 0): a and b are linked.

    The vectors of one length are dealt in chunks by a hash and a task compares one chunk with another, so each pair is
    compared once. It gives at most two rows for each of its vectors, however many links it finds.
    """
    counts = classes.groupBy("size").agg(F.count(F.lit(1)).alias("n"))
    held = F.greatest(F.lit(1), F.least(F.lit(CHUNK), F.floor(CHUNK_BYTES / (8 * F.col("size")))))
    counts = stored(counts.filter("n > 1").select("size", F.ceil(F.col("n") / held).cast("int").alias("chunks")), "size-chunks")
    rows = classes.join(broadcast_if_small(counts), "size")
    rows = rows.withColumn("mine", F.pmod(F.xxhash64("rep", "vector"), F.col("chunks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    rows = rows.select("size", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "rep", "copies", "vector")

    def compare(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        size, i, j = key
        left = frame[frame["mine"] == i]
        right = left if i == j else frame[frame["mine"] == j]
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "n": []}).astype({"a": "int64", "b": "Int64", "n": "int64"})
        rotation = Rotation(int(size), cosine)
        a_rep, b_rep = left["rep"].to_numpy(), right["rep"].to_numpy()
        a_n, b_n = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
        edges: list[tuple[int, int]] = []
        for r, c in tile_links(left, right, rotation, i == j):
            a_n += np.bincount(r, right["copies"].to_numpy()[c], len(left)).astype(np.int64)
            b_n += np.bincount(c, left["copies"].to_numpy()[r], len(right)).astype(np.int64)
            edges = forest(*np.array([*edges, *zip(a_rep[r], b_rep[c])], np.int64).reshape(-1, 2).T)
        counted = pd.DataFrame({"a": np.concatenate([a_rep, b_rep]), "n": np.concatenate([a_n, b_n])})
        counted = counted[counted["n"] > 0].assign(b=pd.NA)
        linked = pd.DataFrame(edges, columns=["a", "b"], dtype="int64").assign(n=0)
        return pd.concat([counted, linked])[["a", "b", "n"]].astype({"a": "int64", "b": "Int64", "n": "int64"})

    grouped = rows.groupBy("size", "i", "j")
    return stored(grouped.applyInPandas(compare, "a long, b long, n long"), "vector-links")


def vector_groups(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """One row per row of `vectors`: vec_id, n_links, component_id, kept.

    Links join vectors of one length with cosine >= `cosine` in double precision. Null, empty and zero vectors and
    those with null or non-finite components link with nothing. Equal vectors are one class with copies. Rows
    without a vec_id take no part and stay, with a null component_id; repeated rows are copies.
    """
    packed = read_vectors(vectors)
    usable = packed.filter("vector is not null and vec_id is not null")
    classes = stored(usable.groupBy("size", "vector").agg(F.min("vec_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("copies")), "vector-classes")
    partial = vector_links(classes, cosine)
    counts = partial.filter("n > 0").groupBy(F.col("a").alias("rep")).agg(F.sum("n").alias("n"))
    found = connected_components(partial.filter("b is not null").select("a", "b")).select(F.col("node").alias("rep"), "component")
    named = classes.join(counts, "rep", "left").join(found, "rep", "left")
    named = named.select(
        F.col("vector").alias("own"),
        (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("component", "rep").alias("component_id"),
    )
    usable_key = F.when(F.col("vec_id").isNotNull(), F.col("vector"))
    joined = packed.join(named, usable_key == F.col("own"), "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", F.col("vec_id").cast("long")))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True))
    )
