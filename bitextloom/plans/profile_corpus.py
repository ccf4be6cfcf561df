"""Profile of a corpus: texts are scanned once, all figures come from the stored frequencies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from bitextloom.defaults import PROFILE_BUCKET_SIZE, PROFILE_MAX_SAMPLES, TEXT_FIELD
from bitextloom.functions.tokens import Tokenizer
from bitextloom.operators.profile import profile_summary, token_frequencies, token_histogram
from bitextloom.session import scratch_path
from bitextloom.sinks.report import format_profile_report
from bitextloom.sources.readers import scan_corpus


@dataclass(frozen=True)
class Profile:
    summary: DataFrame
    histogram: DataFrame

    def report(self) -> str:
        """The text report; one summary row and the buckets come to the driver."""
        bars = self.histogram.orderBy("bucket_start").toLocalIterator()
        return format_profile_report(self.summary.first().asDict(), (bar.asDict() for bar in bars))


def profile_frame(
    df: DataFrame,
    text: str = "text",
    bucket_size: int = PROFILE_BUCKET_SIZE,
    tokenizer: Tokenizer | None = None,
) -> Profile:
    """Profile of a table's text column.

    The frequency table (one row per distinct count) is written to the shared
    folder, so that neither figure scans or tokenizes the texts again.
    """
    spark = df.sparkSession
    stored = scratch_path(spark, "frequencies")
    token_frequencies(df, text, tokenizer).write.parquet(stored)
    freq = spark.read.parquet(stored)
    return Profile(profile_summary(freq), token_histogram(freq, bucket_size))


def profile_corpus(
    spark: SparkSession,
    data_files: str,
    requested_format: str = "auto",
    text_field: str = TEXT_FIELD,
    max_samples: int = PROFILE_MAX_SAMPLES,
    bucket_size: int = PROFILE_BUCKET_SIZE,
    tokenizer: Tokenizer | None = None,
) -> Profile:
    """Profile of the first `max_samples` rows of files; a negative cap means 0."""
    texts = scan_corpus(spark, data_files, requested_format, text_field, cap=max(0, max_samples))
    return profile_frame(texts, "text", bucket_size, tokenizer)
