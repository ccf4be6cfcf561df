"""Token-length profile of a corpus.

Texts are scanned once, into a frequency table (class, token count, rows) that
partial aggregation keeps small: it has one row per distinct count, however
many texts share it. Every statistic is computed from that table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitextloom.defaults import PROFILE_BUCKET_SIZE, PROFILE_PERCENTS
from bitextloom.functions.numbers import bucket_of, pct_of_total
from bitextloom.functions.text import EMPTY, MISSING, OK, SPECIAL, text_class
from bitextloom.functions.tokens import Tokenizer, estimate_tokens
from bitextloom.operators.word_tokens import token_counts

# Bucket numbers are generated in runs of this length, so no array grows with the data.
SPINE_RUN = 4096


def token_frequencies(
    df: DataFrame,
    text: str = "text",
    tokenizer: Tokenizer | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Rows per (`by`, class, token count); a missing, empty or special text counts 0 tokens."""
    content = F.col(text)
    if tokenizer is None:
        kind = text_class(content)
        tokens = F.when(kind == OK, estimate_tokens(content)).otherwise(F.lit(0).cast("bigint"))
    else:
        kept = tuple(by)
        state = F.when(content.isNull(), MISSING).when(content == "", EMPTY)
        df = token_counts(df.select(*by, state.alias("_state"), content.alias("_content")), (*kept, "_state"), tokenizer, "_content", "_counted")
        counted = F.col("_counted")
        kind = (
            F.when(F.col("_state").isNotNull(), F.col("_state"))
            .when(counted < 0, SPECIAL)
            .otherwise(OK)
        )
        tokens = F.greatest(F.coalesce(counted, F.lit(0)), F.lit(0)).cast("bigint")
    marked = df.select(*by, kind.alias("text_class"), tokens.alias("n_tokens"))
    return marked.groupBy(*by, "text_class", "n_tokens").agg(F.count(F.lit(1)).alias("cnt"))


def _rows(condition: Column | None = None) -> Column:
    rows = F.col("cnt") if condition is None else F.when(condition, F.col("cnt"))
    return F.coalesce(F.sum(rows), F.lit(0))


def quality_counts(freq: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Samples, and how many were missing, empty or special."""
    return freq.groupBy(*by).agg(*_quality_columns())


def _quality_columns() -> list[Column]:
    kind = F.col("text_class")
    return [
        _rows().alias("samples"),
        _rows(kind == MISSING).alias("missing_text"),
        _rows(kind == EMPTY).alias("empty_text"),
        _rows(kind == SPECIAL).alias("skipped_special"),
    ]


def token_min_max_mean(freq: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Smallest, largest and mean count over all samples; zeros when there are none."""
    return freq.groupBy(*by).agg(*_range_columns())


def _range_columns() -> list[Column]:
    zero = F.lit(0).cast("bigint")
    total = F.sum(F.col("n_tokens") * F.col("cnt"))
    mean = F.when(_rows() == 0, F.lit(0.0)).otherwise(total / _rows())
    return [
        F.coalesce(F.min("n_tokens"), zero).alias("min_tokens"),
        F.coalesce(F.max("n_tokens"), zero).alias("max_tokens"),
        F.round(mean, 6).alias("mean_tokens"),
    ]


def token_percentiles(
    freq: DataFrame, by: tuple[str, ...] = (), percents: tuple[int, ...] = PROFILE_PERCENTS
) -> DataFrame:
    """Exact percentiles with linear interpolation; 0.0 when there are no samples.

    Weighted by `cnt`: the aggregate holds one entry per distinct count, not per
    row, and distinct counts are bounded by the longest text.
    """
    return _spread(freq.groupBy(*by).agg(_percentile_array(percents)), percents)


def _percentile_array(percents: tuple[int, ...]) -> Column:
    points = F.array(*(F.lit(p / 100.0) for p in percents))
    return F.percentile(F.col("n_tokens"), points, F.col("cnt")).alias("_points")


def _spread(df: DataFrame, percents: tuple[int, ...]) -> DataFrame:
    points = {
        f"p{p}": F.round(F.coalesce(F.col("_points")[i], F.lit(0.0)), 6) for i, p in enumerate(percents)
    }
    return df.withColumns(points).drop("_points")


def profile_summary(
    freq: DataFrame, by: tuple[str, ...] = (), percents: tuple[int, ...] = PROFILE_PERCENTS
) -> DataFrame:
    """Quality counters, range, mean and percentiles in one aggregate."""
    columns = [*_quality_columns(), *_range_columns(), _percentile_array(percents)]
    return _spread(freq.groupBy(*by).agg(*columns), percents)


def bucket_counts(freq: DataFrame, bucket_size: int = PROFILE_BUCKET_SIZE) -> DataFrame:
    """Rows per non-empty bucket."""
    bucket = bucket_of(F.col("n_tokens"), bucket_size).alias("bucket")
    return freq.groupBy(bucket).agg(F.sum("cnt").alias("cnt"))


def histogram_zero_fill(counts: DataFrame) -> DataFrame:
    """Every bucket from 0 to the highest, empty ones with count 0; one zero bucket for no rows.

    Each bucket brings the empty ones up to the next with it, so `counts` (one
    row per bucket, bounded by the longest text) is computed once and joined
    with nothing. Long gaps are generated in runs.
    """
    long = lambda n: F.lit(n).cast("bigint")
    zero = counts.sparkSession.range(1).select(long(0).alias("bucket"), long(0).alias("cnt"))
    known = counts.select("bucket", "cnt").union(zero).groupBy("bucket").agg(F.sum("cnt").alias("cnt"))
    gaps = known.select(
        "bucket",
        "cnt",
        F.coalesce(F.lead("bucket").over(Window.orderBy("bucket")) - 1, F.col("bucket")).alias("last"),
        F.sum("cnt").over(Window.partitionBy()).alias("total"),
    )
    runs = gaps.withColumn("first", F.explode(F.sequence("bucket", "last", long(SPINE_RUN))))
    until = F.least(F.col("last"), F.col("first") + SPINE_RUN - 1)
    filled = runs.withColumn("here", F.explode(F.sequence("first", until)))
    count = F.when(F.col("here") == F.col("bucket"), F.col("cnt")).otherwise(long(0))
    return filled.select(F.col("here").alias("bucket"), count.alias("cnt"), "total")


def token_histogram(freq: DataFrame, bucket_size: int = PROFILE_BUCKET_SIZE) -> DataFrame:
    """Zero-filled histogram with inclusive bucket bounds and percentage of all samples."""
    start = (F.col("bucket") * bucket_size).cast("bigint")
    return histogram_zero_fill(bucket_counts(freq, bucket_size)).select(
        start.alias("bucket_start"),
        (start + (bucket_size - 1)).alias("bucket_end"),
        "cnt",
        F.round(pct_of_total(F.col("cnt"), F.col("total")), 6).alias("pct"),
    )
