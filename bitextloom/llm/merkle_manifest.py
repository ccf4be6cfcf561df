"""Merkle manifest of a table: a tree of hashes for each source, one over all sources, and proofs that fold to its root."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.ranks import ranked
from bitextloom.llm.tables import stored

FAN = 16
# A superblock is what a task reduces at once: so many levels, FAN ** LEVELS nodes at most.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Only the key of the tree over all sources.
ALL = ""
NODES = "tree string, place long, n long, node string"
PATHS = "tree string, place long, path array<string>, subroot string, root string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value: Column) -> Column:
    """UTF-8 byte count, a colon and the value; a dash for null."""
    value = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))


def leaf_hash(text: Column) -> Column:
    return F.sha2(F.concat(*(field(text if name == "text" else F.col(name)) for name in FIELDS)), 256)


def climb(nodes: list[str], n: int, levels: int) -> list[list[str]]:
    """The levels of one superblock of a tree that has `n` nodes on its lowest level, the top alone on the last."""
    rows = [nodes]
    while n > 1 and len(rows) <= levels:
        below = rows[-1]
        rows.append([sha("".join(below[i : i + FAN])) for i in range(0, len(below), FAN)])
        n = -(-n // FAN)
    return rows


def siblings(rows: list[list[str]], place: int) -> list[str]:
    """For each level the hashes to the left and to the right in the run that holds the node of `place`, joined."""
    path = []
    for row in rows[:-1]:
        start = place - place % FAN
        path += ["".join(row[start:place]), "".join(row[place + 1 : start + FAN])]
        place //= FAN
    return path


def fold(node: str, path: list[str]) -> str:
    for left, right in zip(path[::2], path[1::2]):
        node = sha(left + node + right)
    return node


def superblock(levels: int) -> Column:
    return F.expr(f"place div {FAN**levels}").alias("block")


def reduced(nodes: DataFrame, levels: int) -> DataFrame:
    """One node a superblock."""

    def reduce(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        tree, block = key
        frame = frame.sort_values("place")
        n = int(frame["n"].iloc[0])
        top = climb(frame["node"].tolist(), n, levels)[-1][0]
        return pd.DataFrame({"tree": [tree], "place": [block], "n": [-(-n // FAN**levels)], "node": [top]})

    return nodes.groupBy("tree", superblock(levels)).applyInPandas(reduce, NODES)


class Forest:
    """The tiers of trees: nodes by (tree, place), each tier the superblock tops of the one below.

    roots: tree, node and the tier that a tree's root comes from, for every tree.
    """

    def __init__(self, nodes: DataFrame, label: str, levels: int) -> None:
        self.tiers, self.label, self.levels = [], label, levels
        self.roots = None
        while True:
            tops = stored(reduced(nodes.select("tree", "place", "n", "node"), levels), f"{label}-nodes")
            done = tops.filter("n = 1").select("tree", "node", F.lit(len(self.tiers)).alias("tier"))
            self.roots = done if self.roots is None else self.roots.union(done)
            self.tiers.append(nodes)
            nodes = tops.filter("n > 1")
            if nodes.isEmpty():
                return

    def outer(self, roots: DataFrame | None) -> DataFrame | None:
        """Paths of the tops of the lowest tier's superblocks; `roots` are the trees' own, with their tier (None: one tree)."""
        placed = None
        for tier in reversed(range(len(self.tiers))):
            above = placed
            if roots is not None:
                ended = roots.filter(F.col("tier") == tier).drop("tier")
                above = ended if placed is None else placed.union(ended)
            if tier == 0:
                return above
            placed = stored(self.exchanged(tier, above, PATHS, path_rows), f"{self.label}-paths")

    def exchanged(self, tier: int, outer: DataFrame | None, schema: str, finish) -> DataFrame:
        """A tier's nodes and the outer path of their superblock's top, cogrouped: `finish` gets the nodes in order, the
        levels within the superblock, and that path, subroot and root (None where the top is the root of all)."""

        def meet(key: tuple, frame: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("place").reset_index(drop=True)
            if frame.empty:
                return pd.DataFrame({name: [] for name in names})
            rows = climb(frame["node"].tolist(), int(frame["n"].iloc[0]), levels)
            top = above.iloc[0] if len(above) else None
            return finish(frame, rows, top)

        nodes, levels = self.tiers[tier], self.levels
        names = [part.split()[0] for part in schema.split(", ")]
        if outer is None:
            outer = nodes.sparkSession.createDataFrame([], PATHS)
        blocks = nodes.withColumn("block", superblock(levels)).groupBy("tree", "block")
        tops = outer.withColumn("block", F.col("place")).groupBy("tree", "block")
        return blocks.cogroup(tops).applyInPandas(meet, schema)


def path_rows(frame: pd.DataFrame, rows: list[list[str]], top) -> pd.DataFrame:
    onward = [] if top is None else list(top["path"])
    paths = [siblings(rows, i) + onward for i in range(len(frame))]
    root = rows[-1][0] if top is None else top["root"]
    subroot = frame["node"] if top is None or top["subroot"] is None else top["subroot"]
    return pd.DataFrame({"tree": frame["tree"], "place": frame["place"], "path": paths, "subroot": subroot, "root": root})


def source_rows(frame: pd.DataFrame, rows: list[list[str]], top) -> pd.DataFrame:
    """Paths of the subroots, each the one top of its source."""
    return path_rows(frame, rows, top).assign(tree=frame["source"], place=0, subroot=frame["node"], tier=frame["tier"])


def merkle_manifest(docs: DataFrame, received: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """One row per row of `docs`: doc_id, leaf, subroot, root, proof, folded_root, verified.

    A leaf is the sha256 (lowercase hex) of doc_id, source, lang, n_chars and text, each as its byte count, a colon and
    the value, or a dash for null. The leaves of a source ascend by doc_id (nulls first, then by leaf);
    while there are several nodes, each 16 in a row become the sha256 of their joined digests. Sources ascend by their
    bytes, null first, and their subroots make the root likewise. proof has the joined siblings to the left and to the
    right on each level from the leaf to the root. `received` is the text as it came back: folded_root is what its leaf
    and the proof give, verified whether that is the root. Without it the text itself is folded. A null text as
    received has a dash for its field. Empty and long texts are ordinary values; repeated rows are leaves each; an empty table has no rows.

    Leaves are ranked by ranges, so a source of any size lies in many tasks. Each superblock of 16 ** `levels` nodes is
    reduced on its own, tier by tier; then each tier's nodes meet the outer path of their superblock, from the top down, and
    the lowest finishes reduction, proof and fold at once. Only hashes are shuffled, never texts.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    text = F.col("text").cast("string")
    leaf = leaf_hash(text)
    came = F.lit(None).cast("string") if received is None else F.nullif(leaf_hash(received), leaf)
    source = F.col("source").cast("string")
    leaves = docs.select(
        F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("tree"), "doc_id", leaf.alias("node"), came.alias("came")
    )
    # As text, for pandas would make floating-point numbers of ids beside nulls.
    placed = ranked(leaves, "tree", ["doc_id", "node"], "leaves").withColumn("doc_id", F.col("doc_id").cast("string"))
    sources = Forest(placed, "sources", levels)
    subroots = sources.roots.select(F.lit(ALL).alias("tree"), F.col("tree").alias("source"), "node", "tier")
    whole = Forest(stored(ranked(subroots, "tree", ["source"], "subroots"), "ranked-subroots"), "whole", levels)
    tops = whole.exchanged(0, whole.outer(None), f"{PATHS}, tier int", source_rows)
    tops = stored(tops, "subroot-paths")

    def proofs(frame: pd.DataFrame, rows: list[list[str]], top) -> pd.DataFrame:
        onward = list(top["path"])
        paths = [siblings(rows, i) + onward for i in range(len(frame))]
        leaves, came = frame["node"].tolist(), frame["came"].tolist()
        folded = [fold(c if isinstance(c, str) else leaf, path) for leaf, c, path in zip(leaves, came, paths)]
        out = {"doc_id": frame["doc_id"], "leaf": leaves, "subroot": top["subroot"], "root": top["root"], "proof": paths, "folded_root": folded}
        return pd.DataFrame(out | {"verified": [f == top["root"] for f in folded]})

    schema = "doc_id string, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean"
    found = sources.exchanged(0, sources.outer(tops), schema, proofs)
    return found.withColumn("doc_id", F.col("doc_id").cast(kind))
