"""Shard names and numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def shard_name(prefix: Column, shard_id: Column) -> Column:
    """`prefix-00042.parquet`"""
    return F.format_string("%s-%05d.parquet", prefix, shard_id)


def shard_number(name: Column, prefix: str | None = None) -> Column:
    """Number in a shard's file name; null where the name does not fit.

    Without a prefix any text before the last dash is accepted.
    """
    head = ".*" if prefix is None else re.escape(prefix)
    return F.regexp_extract(name, rf"^{head}-(\d+)\.parquet$", 1).try_cast("bigint")


def next_shard_id(number: Column) -> Column:
    """Aggregate: one more than the highest shard number, 0 when there is none."""
    return F.coalesce(F.max(number) + 1, F.lit(0)).cast("bigint")
