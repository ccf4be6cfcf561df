"""The manifest against a plain tree."""

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from bitextloom.llm.catalog import crc32, lower_case
from bitextloom.llm.merkle_manifest import fold, merkle_manifest

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """The root, and for each node its siblings as (left, right) by level."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for path, place in zip(paths, places):
            start = place // 16 * 16
            path.append(("".join(nodes[start:place]), "".join(nodes[place + 1 : start + 16])))
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
        places = [p // 16 for p in places]
    return nodes[0], paths


def plain(rows):
    by_source = defaultdict(list)
    for row in rows:
        by_source[row["source"]].append((row, leaf(row["doc_id"], row["source"], row["lang"], row["n_chars"], row["text"])))
    order = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees, result = {}, []
    for source in order:
        own = sorted(by_source[source], key=lambda x: (x[0]["doc_id"] is not None, x[0]["doc_id"] or 0, x[1]))
        trees[source] = own, *tree([x[1] for x in own])
    root, outer = tree([trees[s][1] for s in order])
    for source, above in zip(order, outer):
        own, subroot, paths = trees[source]
        for (row, node), path in zip(own, paths):
            path = path + above
            folded, text = node, row["text"]
            if row["doc_id"] is not None and text is not None and zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0:
                folded = leaf(row["doc_id"], source, row["lang"], row["n_chars"], text.translate(LOWER))
            for left, right in path:
                folded = sha(left + folded + right)
            proof = sha("".join(left + right for left, right in path))
            result.append((row["doc_id"], node, subroot, root, proof, folded, folded == root))
    return sorted(result, key=str)


def found(docs, **options):
    text = F.col("text")
    got = merkle_manifest(docs, F.when(crc32(F.col("doc_id")) % 5 == 0, lower_case(text)).otherwise(text), **options)
    got = got.withColumn("proof", F.sha2(F.array_join("proof", ""), 256)).select(
        "doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"
    )
    return sorted(map(tuple, got.collect()), key=str)


def test_edges(edge, clashing, none):
    assert found(edge) == plain(edge.collect())
    assert found(clashing.withColumn("place", F.lit("x")).withColumn("tree", F.lit(1))) == plain(edge.collect())
    assert found(none) == []


@pytest.mark.parametrize("levels", [1, 3])
def test_small_tables(small, levels):
    """Superblocks of 16 make several tiers, of subroots too."""
    many = small.withColumn("source", F.concat(F.lit("s"), F.pmod(F.col("doc_id"), F.lit(40)).cast("string")))
    docs = small.withColumn("source", F.when(F.col("doc_id") % 7 > 0, F.col("source"))).union(small).union(many)
    assert found(docs, levels=levels) == plain(docs.collect())


def test_one_row_and_proofs(spark):
    docs = spark.createDataFrame([(7, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    row = merkle_manifest(docs).first()
    assert row["leaf"] == row["subroot"] == row["root"] == leaf(7, None, None, None, None)
    assert row["proof"] == [] and row["verified"]
    docs = spark.range(40).selectExpr("id as doc_id", "'a' as source", "'' as lang", "1 as n_chars", "repeat('x', id) as text")
    rows = merkle_manifest(docs).collect()
    assert len({r["root"] for r in rows}) == 1
    assert all(r["verified"] and fold(r["leaf"], r["proof"]) == r["root"] for r in rows)
    changed = merkle_manifest(docs, F.concat("text", F.lit("!"))).collect()
    assert not any(r["verified"] for r in changed)
