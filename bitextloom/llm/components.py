"""Connected components of a table of links by randomised contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.tables import stored


def connected_components(links: DataFrame) -> DataFrame:
    """node and component (the smallest node reachable) for every node of `links` (a, b: long).

    In each round every node moves to the neighbour, or itself, with the smallest hash of that round, and
    links are mapped along. A fresh hash each round shrinks paths and stars alike by a constant factor on average,
    so rounds grow with the logarithm of the nodes. Each round is written to the shared folder.
    """
    live = stored(links.filter("a <> b").select("a", "b").distinct(), "links")
    where = None
    turn = 0
    while not live.isEmpty():
        ranked = F.struct(F.xxhash64("b", F.lit(turn)).alias("h"), F.col("b").alias("to"))
        both = live.union(live.select("b", "a"))
        least = both.groupBy("a").agg(F.min(ranked).alias("least"))
        own = F.struct(F.xxhash64("a", F.lit(turn)).alias("h"), F.col("a").alias("to"))
        moves = stored(least.select(F.col("a").alias("was"), F.least("least", own).getField("to").alias("now")), "moves")
        first = moves.select(F.col("was").alias("a"), F.col("now").alias("x"))
        second = moves.select(F.col("was").alias("b"), F.col("now").alias("y"))
        mapped = live.join(first, "a").join(second, "b").filter("x <> y")
        live = stored(mapped.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
        if where is None:
            where = moves.select(F.col("was").alias("node"), F.col("now").alias("at"))
        else:
            onward = moves.select(F.col("was").alias("at"), "now")
            where = where.join(onward, "at", "left").select("node", F.coalesce("now", "at").alias("at"))
            where = stored(where, "where")
        turn += 1
    if where is None:
        return links.select(F.col("a").alias("node"), F.col("a").alias("component")).limit(0)
    least = where.groupBy("at").agg(F.min("node").alias("component"))
    return where.join(least, "at").select("node", "component")
