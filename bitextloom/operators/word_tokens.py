"""Token counts over a table of distinct words: texts are split by the engine, the encoder sees each word once."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.functions.text import has_special_token
from bitextloom.functions.tokens import FAILED, Tokenizer
from bitextloom.session import scratch_path

# The word table is broadcast up to so many rows and bytes of words; beyond, its most frequent words are, and the others joined by shuffle.
BROADCAST_WORDS = 500_000
BROADCAST_BYTES = 32 * 2**20
WORD, SIZE, TIMES, ROW = "_word", "_size", "_times", "_row"


def word_table(texts: DataFrame, text: str, tokenizer: Tokenizer) -> DataFrame:
    """Each distinct word of the texts (a piece that the encoding's pattern cuts), its tokens, -1 where refused, and occurrences; stored.

    Words are made distinct in each task before they are shuffled, so what moves grows with the vocabulary.
    """

    @F.pandas_udf("int")
    def size(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer.load().encode_ordinary

        def count(word: str) -> int:
            try:
                return len(encode(word))
            except Exception:  # a refused word makes a failed text, never a failed job
                return FAILED

        for words in batches:
            yield words.map(count).astype("int32")

    words = texts.select(F.explode(pieces(text, tokenizer)).alias(WORD)).groupBy(WORD).agg(F.count(F.lit(1)).alias(TIMES))
    path = scratch_path(texts.sparkSession, "words")
    words.select(WORD, size(WORD).alias(SIZE), TIMES).write.parquet(path)
    return texts.sparkSession.read.parquet(path)


def pieces(text: str, tokenizer: Tokenizer):
    return F.regexp_extract_all(F.col(text), F.lit(tokenizer.split_pattern()), F.lit(0))


def _widened(df: DataFrame) -> DataFrame:
    """Rows of a few large splits dealt out to all cores; with as many splits as cores nothing moves."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def frequent_from(words: DataFrame) -> int:
    """The occurrences from which on words are broadcast: 0 if all are, else a power of two that so few words reach.

    A word below it has no more than its share of the texts, so none of the words that are shuffled fills a task.
    """
    level = F.floor(F.log2(TIMES)).alias("level")
    held = words.groupBy(level).agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(WORD)).alias("size"))
    # One row for each power of two.
    rows = size = 0
    for found in sorted(held.collect(), reverse=True):
        rows, size = rows + found["n"], size + found["size"]
        if rows > BROADCAST_WORDS or size > BROADCAST_BYTES:
            return 2 ** (found["level"] + 1)
    return 0


def token_counts(
    df: DataFrame, keep: tuple[str, ...], tokenizer: Tokenizer, text: str = "text", name: str = "n_tokens"
) -> DataFrame:
    """The `keep` columns of every row and its tokens: 0 for empty, null for null, -1 where the encoding refuses the text.

    The same counts as `functions.token_count`, for whole tables. Only distinct words reach Python. Where the word table
    is broadcast, a row's words meet their sizes and are summed in the task that reads them; one narrow row each is shuffled.
    Of a larger table that goes for the frequent words, and only occurrences of the others are shuffled too.
    """
    rows = _widened(df.select(*keep, F.col(text).alias("_text"))).withColumn(ROW, F.monotonically_increasing_id())
    refused = has_special_token(F.col("_text"), tokenizer.special_names)
    rows = rows.select(*keep, ROW, F.when(refused, FAILED).when(F.col("_text").isNotNull(), 0).alias("_known"), F.when(~refused, F.col("_text")).alias("_text"))
    words = word_table(rows.where("_text <> ''"), "_text", tokenizer)
    least = frequent_from(words)
    cut = rows.select(*keep, ROW, "_known", F.explode_outer(pieces("_text", tokenizer)).alias(WORD))
    sized = cut.join(F.broadcast(words.where(F.col(TIMES) >= least).select(WORD, SIZE)), WORD, "left")
    if least:
        rare = F.when(F.col(SIZE).isNull(), F.col(WORD))
        # Rows are summed by frequent words first; what is left of each is one row without a word, dealt by its own number.
        sums = sized.groupBy(ROW, "_known", *keep, rare.alias("_rare")).agg(F.sum(SIZE).alias("_sum"), F.min(SIZE).alias("_low"), F.count(F.lit(1)).alias("_n"))
        sums = sums.withColumn("_deal", F.when(F.col("_rare").isNull(), F.col(ROW)).otherwise(-1))
        others = words.where(F.col(TIMES) < least).select(F.col(WORD).alias("_rare"), F.lit(-1).cast("bigint").alias("_deal"), F.col(SIZE).alias("_own"))
        sized = sums.join(others, ["_rare", "_deal"], "left")
        low, size = F.coalesce("_own", "_low"), F.coalesce(F.col("_own") * F.col("_n"), "_sum")
    else:
        low = size = F.col(SIZE)
    failed = F.max(F.coalesce(low < 0, F.lit(False)))
    total = F.when(failed | (F.col("_known") == FAILED), F.lit(FAILED)).otherwise(F.col("_known") + F.coalesce(F.sum(size), F.lit(0)))
    counted = sized.groupBy(ROW, "_known", *keep).agg(total.cast("bigint").alias(name))
    return counted.select(*keep, name)
