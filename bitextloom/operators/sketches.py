"""Token percentiles from mergeable sketches: one a file or batch is stored, and later runs merge them without the texts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.defaults import PROFILE_PERCENTS
from bitextloom.functions.text import OK, text_class
from bitextloom.functions.tokens import estimate_tokens
from bitextloom.sources.paths import path_exists

# Size parameter of the sketches (KLL): some 25 KB each at most, however many rows they stand for.
SKETCH_K = 2000
STORED = "part string, samples bigint, sketch binary, stored_at timestamp"


def rank_error(k: int = SKETCH_K) -> float:
    """How far the rank of a percentile may be off, as a share of all rows, in 99 of 100 cases, for sketches merged in any order.

    The published bound of the sketch: 2.296 / k ** 0.9723.
    """
    return 2.296 / k**0.9723


def token_sketches(df: DataFrame, part: Column, text: str = "text", k: int = SKETCH_K) -> DataFrame:
    """part, samples and sketch of the (estimated) token counts of each part's rows, for a `part` such as a file or a batch.

    A missing, empty or special text counts 0 tokens, as in the exact profile. Sketches are built where the rows are read, and
    only they are shuffled.
    """
    content = F.col(text)
    tokens = F.when(text_class(content) == OK, estimate_tokens(content)).otherwise(F.lit(0).cast("bigint"))
    marked = df.select(part.cast("string").alias("part"), tokens.alias("_tokens"))
    return marked.groupBy("part").agg(F.count(F.lit(1)).alias("samples"), F.kll_sketch_agg_bigint("_tokens", k).alias("sketch"))


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Append the sketches of new parts; a part that is stored again replaces what is known of it."""
    rows = sketches.select("part", "samples", "sketch", F.current_timestamp().alias("stored_at"))
    rows.coalesce(1).write.mode("append").parquet(path)


def stored_sketches(spark: SparkSession, path: str) -> DataFrame:
    """part, samples, sketch: the newest of each part."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], STORED).drop("stored_at")
    rows = spark.read.schema(STORED).parquet(path)
    newest = F.max_by(F.struct("samples", "sketch"), "stored_at").alias("newest")
    return rows.groupBy("part").agg(newest).select("part", "newest.*")


def sketch_percentiles(
    sketches: DataFrame, by: tuple[str, ...] = (), percents: tuple[int, ...] = PROFILE_PERCENTS, k: int = SKETCH_K
) -> DataFrame:
    """samples, smallest, largest and percentiles of all rows that the sketches stand for, per `by`; null without any.

    Merging is one aggregate over binaries of bounded size. A percentile is a count that some row has, whose rank is within
    `rank_error(k)` of the wanted one.
    """
    merged = sketches.groupBy(*by).agg(F.coalesce(F.sum("samples"), F.lit(0)).alias("samples"), F.kll_merge_agg_bigint("sketch", k).alias("_all"))
    at = lambda share: F.kll_sketch_get_quantile_bigint("_all", F.lit(float(share)))
    held = F.col("samples") > 0
    columns = {"min_tokens": at(0.0), "max_tokens": at(1.0), **{f"p{p}": at(p / 100.0) for p in percents}}
    return merged.select(*by, "samples", *(F.when(held, value).alias(name) for name, value in columns.items()))
