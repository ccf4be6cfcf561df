"""Filter a corpus by token count into parquet: one scan, counters observed while writing."""

from __future__ import annotations

from pyspark.sql import Observation, Row, SparkSession
from pyspark.sql import functions as F

from bitextloom.defaults import FILTER_MAX_FILE_MB, FILTER_MAX_TOKENS, FILTERED_COLUMN, TEXT_FIELD
from bitextloom.functions.tokens import Tokenizer
from bitextloom.operators.filters import fate, fate_counters
from bitextloom.sinks.parquet import write_by_size
from bitextloom.sources.readers import scan_corpus


def filter_corpus(
    spark: SparkSession,
    data_files: str,
    out: str,
    text_field: str = TEXT_FIELD,
    max_tokens: int = FILTER_MAX_TOKENS,
    max_samples: int = -1,
    max_file_mb: int = FILTER_MAX_FILE_MB,
    tokenizer: Tokenizer | None = None,
    shuffle: bool = True,
    mode: str = "errorifexists",
) -> Row:
    """Write texts below the limit as `en_text` and return the counters.

    The cap counts scanned rows, dropped ones included.
    """
    texts = scan_corpus(spark, data_files, text_field=text_field, cap=max_samples, fall_back=False)
    counters = Observation("filter")
    marked = texts.withColumn("fate", fate(F.col("text"), max_tokens, tokenizer))
    counted = marked.observe(counters, *fate_counters(F.col("fate")))
    kept = counted.where(F.col("fate") == "kept").select(F.col("text").alias(FILTERED_COLUMN))
    write_by_size(kept, out, max_file_mb, shuffle=shuffle, mode=mode)
    return Row(**counters.get)
