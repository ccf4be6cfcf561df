"""Running totals over an ordered table, in one task while it is small, in many when it is not."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitextloom.session import scratch_path

# Tables up to this many rows are ordered in one task (some 20 MB of paths and counts).
ONE_TASK_ROWS = 100_000


def running_total(df: DataFrame, order: list[str], value: str, name: str, rows: int) -> DataFrame:
    """Add the sum of `value` over all rows before this one in `order`.

    `rows` is the table's size, or a bound of it. Beyond `ONE_TASK_ROWS` the
    table is range-partitioned and stored with its partition number; partition
    totals (one row per partition) then shift the totals inside each partition.
    """
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    if rows <= ONE_TASK_ROWS:
        return df.withColumn(name, F.coalesce(F.sum(value).over(before), F.lit(0)))
    spark = df.sparkSession
    stored_path = scratch_path(spark, "ranges")
    parts = -(-rows // ONE_TASK_ROWS) + 1
    ranged = df.repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id())
    ranged.write.parquet(stored_path)
    stored = spark.read.parquet(stored_path)
    totals = stored.groupBy("_part").agg(F.sum(value).alias("_sum"))
    earlier_parts = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shifts = totals.select("_part", F.coalesce(F.sum("_sum").over(earlier_parts), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = stored.withColumn(name, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    # One row per partition: rows / ONE_TASK_ROWS of them.
    shifted = local.join(F.broadcast(shifts), "_part")
    return shifted.withColumn(name, F.col(name) + F.col("_shift")).drop("_part", "_shift")
