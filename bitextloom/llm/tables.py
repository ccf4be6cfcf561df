"""Shared pieces of the corpus operators: stored tables, size-checked broadcasts, dropped rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.session import scratch_path

# A side is broadcast up to this many rows of fixed-width columns (some tens of MB), joined by shuffle beyond.
BROADCAST_ROWS = 500_000


def stored(df: DataFrame, label: str) -> DataFrame:
    """The frame written to the shared scratch folder and read back: computed once, no lineage to replay."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` with a broadcast hint if it is counted to at most `rows`; store a costly `df` first.

    Only for narrow rows of bounded width. Beyond, the planner shuffles and splits skewed keys.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def text_digest():
    return F.unhex(F.sha2(text_or_empty().cast("binary"), 256))


def kept_rows(df: DataFrame, decided: DataFrame) -> DataFrame:
    """Rows of `df` that `decided` keeps: a row is known by its doc_id and the digest of its text, one row of equal ones stays.

    `decided` (stored) has doc_id, digest and kept of every row. Null equals null. Columns of `df` may have any names. Texts are
    shuffled only where the rows to drop are too many to broadcast, or are repeated rows.
    """
    names = [f"`{name}`" for name in df.columns]
    mine = df.select(F.struct(*names).alias("row"), F.col("doc_id").alias("id"), text_digest().alias("digest"))

    def among(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        keys = broadcast_if_small(keys.select(F.col("doc_id").alias("other_id"), F.col("digest").alias("other")))
        return rows.join(keys, F.col("id").eqNullSafe(F.col("other_id")) & F.col("digest").eqNullSafe(F.col("other")), how)

    lost = stored(decided.filter("not kept").select("doc_id", "digest").distinct(), "lost-rows")
    stay = among(mine, lost, "left_anti")
    again = decided.filter("kept").groupBy("doc_id", "digest").count().filter("count > 1")
    again = stored(again.select("doc_id", "digest"), "repeated-rows")
    if not again.isEmpty():
        stay = among(stay, again, "left_anti").union(among(stay, again, "left_semi").dropDuplicates(["id", "digest"]))
    return stay.select("row.*")


def without_ids(df: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of `df` whose doc_id is not among the (stored) `ids`; rows without an id stay.

    A semi-join, so no column is added whatever extra columns `df` has.
    """
    return df.join(broadcast_if_small(ids.select("doc_id")), "doc_id", "left_anti").select(*df.columns)


def text_or_empty(name: str = "text"):
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
