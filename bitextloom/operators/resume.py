"""Keyed resume and reassembly."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitextloom.functions.shards import next_shard_id, shard_number
from bitextloom.sources.counts import rows_per_file, unreadable_files
from bitextloom.sources.paths import expand_paths, list_files, path_exists

# Stretches of positions that done ranges are dealt by.
STRETCHES = 4096


def resume_pending(source: DataFrame, done: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows of the source that the output does not hold yet; only keys of the output are read. A null key equals a null key."""
    stored = done.select(F.col(key).alias("_done"))
    return source.join(stored, F.col(key).eqNullSafe(F.col("_done")), "left_anti")


def pending_ranges(done: DataFrame, end: int, size: int) -> DataFrame:
    """Ranges `first, last` of at most `size` positions below `end` that no range of `done` (first, last) holds.

    Done ranges may overlap, repeat, nest, be empty or reach beyond the end. A range is looked at with the
    furthest end of all ranges that begin before it; where it begins later, there is a gap. Ranges are dealt by where they
    begin; of each stretch only its furthest end is needed by the later ones, STRETCHES numbers in all, so no task sees the whole table.
    """
    stretch = max(1, -(-end // STRETCHES))
    last_one = done.sparkSession.range(1).select(F.lit(end).cast("bigint").alias("first"), F.lit(end + 1).cast("bigint").alias("last"))
    ranges = done.select(F.col("first").cast("bigint").alias("first"), F.col("last").cast("bigint").alias("last"))
    ranges = ranges.where(f"last > first AND first < {end}").union(last_one)
    # What begins before position 0 covers from there.
    ranges = ranges.withColumn("stretch", F.expr(f"greatest(first, 0) div {stretch}"))
    tops = ranges.groupBy("stretch").agg(F.max("last").alias("top"))
    earlier = F.max("top").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1))
    tops = tops.select("stretch", F.coalesce(earlier, F.lit(0)).alias("reached"))
    inside = Window.partitionBy("stretch").orderBy("first", "last").rowsBetween(Window.unboundedPreceding, -1)
    # At most STRETCHES + 1 rows.
    met = ranges.join(F.broadcast(tops), "stretch").withColumn("low", F.greatest("reached", F.coalesce(F.max("last").over(inside), F.lit(0))))
    gaps = met.where("first > low").select("low", F.col("first").alias("high"))
    steps = F.explode(F.sequence(F.lit(0).cast("bigint"), F.expr(f"(high - low - 1) div {size}")))
    cut = gaps.select("low", "high", steps.alias("step"))
    first = F.col("low") + F.col("step") * size
    return cut.select(first.alias("first"), F.least(first + size, F.col("high")).alias("last"))


def reassemble_in_order(source: DataFrame, results: DataFrame, key: str = "row_id") -> DataFrame:
    """Every source row with its result, however the results arrived.

    The order itself is the key's; `write_ordered` lays it out on disk.
    """
    return source.join(results, key, "left")


def existing_rows(
    spark: SparkSession,
    path: str,
    prefix: str | None = None,
    on_unreadable: str = "skip",
    committed: bool = False,
) -> DataFrame:
    """Rows per shard of an output folder, from the footers: `shard, rows`.

    An unreadable shard is left out (`skip`) or raises (`fail`). Leaving
    it out is safe with a keyed resume, which redoes its rows; a positional
    resume must use `fail`. `committed` counts only subfolders whose job
    finished, by Spark's success mark. Only shards that give no row are looked at one by one.
    """
    none = spark.createDataFrame([], "shard string, rows bigint")
    if not path_exists(spark, path):
        return none
    shards = list_files(spark, path, f"{prefix}-*.parquet" if prefix else "*.parquet")
    if committed:
        finished = [mark.split("/")[-2] for mark in expand_paths(spark, f"{path.rstrip('/')}/*/_SUCCESS")]
        shards = shards.where(F.element_at(F.split("path", "/"), -2).isin(finished))
    paths = [row["path"] for row in shards.select("path").collect()]
    if not paths:
        return none
    counted = rows_per_file(spark, paths)
    silent = [row["path"] for row in shards.join(counted, "path", "left_anti").select("path").collect()]
    broken = unreadable_files(spark, silent) if silent else []
    if broken and on_unreadable == "fail":
        raise ValueError(f"unreadable shard {broken[0]}")
    empty = [(name, 0) for name in silent if name not in set(broken)]
    counted = counted.union(spark.createDataFrame(empty, "path string, rows bigint"))
    return counted.select(F.element_at(F.split("path", "/"), -1).alias("shard"), "rows")


def next_shard_number(spark: SparkSession, path: str, prefix: str) -> int:
    """One more than the highest shard number in an output folder, 0 for none."""
    if not path_exists(spark, path):
        return 0
    names = list_files(spark, path, f"{prefix}-*.parquet")
    return names.agg(next_shard_id(shard_number(F.col("name"), prefix)).alias("n")).first()["n"]
