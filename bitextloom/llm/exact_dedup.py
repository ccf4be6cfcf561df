"""Exact deduplication with a split of heavy hitters; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.tables import kept_rows, stored, text_or_empty

# Digests of more than this share of all rows are surely found, so at most 1 / SUPPORT are broadcast.
SUPPORT = 1 / 1024


def heavy_groups(digests: DataFrame, support: float = SUPPORT) -> DataFrame:
    """Frequent digests with their verified keep_id and group_size, at most 1 / support rows.

    `freqItems` is the Misra-Gries summary: one pass, 1 / support counters a task, merged; it misses no
    digest above the share, and what it adds by mistake is only counted exactly here as well.
    """
    frequent = digests.freqItems(["text_sha256"], support).select(
        F.explode("text_sha256_freqItems").alias("text_sha256")
    )
    return (
        digests.join(F.broadcast(frequent), "text_sha256", "left_semi")
        .groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    )


def exact_groups(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """One row per row of `docs`: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical; null counts as empty. The largest doc_id of a group stays. Null ids are
    smaller than any id; where a group has no other, keep_id is null and its rows stay. Repeated rows of
    one doc_id and text count in group_size and share one decision. Only ids and digests are shuffled, never texts.
    """
    digests = stored(
        docs.select("doc_id", F.sha2(text_or_empty().cast("binary"), 256).alias("text_sha256")), "digests"
    )
    heavy = stored(heavy_groups(digests, support), "heavy")
    split = digests.join(F.broadcast(heavy), "text_sha256", "left")
    found = split.filter(F.col("group_size").isNotNull())
    rest = split.filter(F.col("group_size").isNull()).select("doc_id", "text_sha256")
    repeated = (
        rest.groupBy("text_sha256")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .filter("group_size > 1")
    )
    once = F.col("group_size").isNull()
    ordinary = rest.join(repeated, "text_sha256", "left").select(
        "doc_id",
        F.when(once, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        "text_sha256",
    )
    return ordinary.unionByName(found.select("doc_id", "keep_id", "group_size", "text_sha256")).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256"
    )


def drop_exact_copies(docs: DataFrame, support: float = SUPPORT) -> DataFrame:
    """`docs` without the copies that `exact_groups` does not keep, by doc_id and text; all columns stay as they are.

    One row of each text stays: of rows equal in doc_id and text any one, as they differ in other columns alone; of a text
    that only rows without a doc_id have, any one of those.
    """
    decided = exact_groups(docs, support).select("doc_id", F.unhex("text_sha256").alias("digest"), "kept")
    return kept_rows(docs, stored(decided, "exact-decided"))
