"""Places of rows within their group, counted over the whole cluster."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from bitextloom.llm.tables import broadcast_if_small, stored

# monotonically_increasing_id keeps the row of its partition in so many low bits.
ROW_BITS = 33


def ranked(df: DataFrame, key: str, order: list[str], label: str) -> DataFrame:
    """`df` with place (0, 1, ... by `order` within `key`, nulls first) and n (rows of the key).

    Rows are dealt by ranges of key and order, so a key of any size lies in many tasks. A task numbers its own rows;
    one row for each key and task is summed up to where each begins. Rows equal in key and order are placed
    in any order: order by all that must tell them apart. `key` is never null.
    """
    by = [F.col(name).asc_nulls_first() for name in (key, *order)]
    dealt = df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    rows = stored(dealt.withColumn("part", F.shiftright("at", ROW_BITS)), label)
    parts = rows.groupBy(key, "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("own"))
    each = Window.partitionBy(key)
    begun = F.sum("own").over(each.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select(
        key, "part", (F.coalesce(begun, F.lit(0)) - F.col("first")).alias("shift"), F.sum("own").over(each).alias("n")
    )
    joined = rows.join(broadcast_if_small(stored(parts, f"{label}-parts")), [key, "part"])
    return joined.select(*df.columns, (F.col("at") + F.col("shift")).alias("place"), "n")
