"""The first n rows by a key, at any n, without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# One round counts keys in this many equal ranges; only these counts reach the driver.
RANGES = 2048
# A range with at most this many rows is sorted outright.
SORT_ROWS = 50_000

INTEGRAL = {"tinyint", "smallint", "int", "bigint"}


def nth_key(df: DataFrame, key: str, n: int) -> int | None:
    """The n-th smallest key (from 1), or None when there are fewer rows.

    Narrows a key range round by round: count keys per sub-range, step into the
    one that holds the n-th. Each round reads the key column alone with the
    range pushed to the scan, and needs a partial aggregate of `RANGES` rows.
    """
    if dict(df.dtypes)[key] not in INTEGRAL:
        raise TypeError(f"{key} must be an integer column")
    keys = df.select(F.col(key).cast("bigint").alias(key)).where(F.col(key).isNotNull())
    low, high, total = keys.agg(F.min(key), F.max(key), F.count("*")).first()
    if total < n:
        return None
    here, rank = total, n
    while low < high:
        inside = keys.where(F.col(key).between(low, high))
        if here <= SORT_ROWS:
            return inside.orderBy(key).offset(rank - 1).limit(1).first()[0]
        width = max(1, -(-(high - low + 1) // RANGES))
        # In decimals: two keys can be further apart than a bigint holds.
        place = F.col(key).cast("decimal(20,0)") - F.lit(low).cast("decimal(20,0)")
        counts = (
            inside.groupBy(F.floor(place / F.lit(width).cast("decimal(20,0)")).cast("bigint").alias("range"))
            .agg(F.count("*").alias("rows"))
            .orderBy("range")
            .collect()
        )
        for bucket, rows in counts:
            if rank <= rows:
                here = rows
                low, high = low + bucket * width, min(high, low + (bucket + 1) * width - 1)
                break
            rank -= rows
    return low


def first_rows_by_key(df: DataFrame, key: str, cap: int) -> DataFrame:
    """The `cap` rows with the smallest keys; 0 gives none.

    The result is a plain filter on the key: it reaches the scan, and rows stay
    where they are. Null keys come after all others. A key, null too, shared
    across the cut is an error, as either choice would be arbitrary.
    """
    if cap <= 0:
        return df.where(F.lit(False))
    last = nth_key(df, key, cap)
    if last is None:
        found = df.select(F.count(key), F.count(F.lit(1))).first()
        if found[0] < cap < found[1]:
            raise ValueError(f"{key} null is shared by rows on both sides of the cut")
        return df if found[1] <= cap else df.where(F.col(key).isNotNull())
    capped = df.where(F.col(key) <= last)
    if capped.select(key).count() != cap:
        raise ValueError(f"{key} {last} is shared by rows on both sides of the cut")
    return capped


def profile_cap(df: DataFrame, key: str, max_samples: int) -> DataFrame:
    """Cap of the profile: a negative cap means 0."""
    return first_rows_by_key(df, key, max(0, max_samples))


def filter_cap(df: DataFrame, key: str, max_samples: int) -> DataFrame:
    """Cap of the filter, on scanned rows, before any row is dropped; negative means all."""
    return df if max_samples < 0 else first_rows_by_key(df, key, max_samples)


def translate_cap(df: DataFrame, max_samples: int, ordinal: Column | None = None) -> DataFrame:
    """Cap of the enrichment, on the output position: rows of earlier runs count."""
    position = F.col("ordinal") if ordinal is None else ordinal
    return df if max_samples < 0 else df.where(position < max_samples)
