"""Row filters, projections and the filter report. One narrow stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bitextloom.defaults import FILTER_MAX_TOKENS, SOURCE_COLUMN, TARGET_COLUMN
from bitextloom.functions.text import has_special_token
from bitextloom.functions.tokens import Tokenizer, estimate_tokens, token_count

FATES = ("missing", "special", "kept", "over_limit")


def drop_missing_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop null texts. An empty text is not missing."""
    return df.where(F.col(text).isNotNull())


def drop_special_token_text(df: DataFrame, text: str = "text", names: list[str] | None = None) -> DataFrame:
    """Drop texts a tokenizer would refuse because they embed a special token."""
    return df.where(~has_special_token(F.col(text), names))


def below_limit(text: Column, max_tokens: int, tokenizer: Tokenizer | None = None) -> Column:
    """True where a text has fewer than `max_tokens` tokens.

    With a tokenizer, a text that it refuses is never below the limit, whatever
    its length. For the others byte length decides most rows exactly: every
    token has at least one byte and at most `longest` bytes. Only texts in
    between are sent to Python; the others reach the encoder as null.
    """
    if tokenizer is None:
        return estimate_tokens(text) < max_tokens
    size, counted = F.octet_length(text).cast("bigint"), _counted_between(text, max_tokens, tokenizer)
    fits = (size < max_tokens) | F.coalesce((counted >= 0) & (counted < max_tokens), F.lit(False))
    return fits & ~has_special_token(text, tokenizer.special_names)


def _counted_between(text: Column, max_tokens: int, tokenizer: Tokenizer) -> Column:
    """The encoder's count where byte length leaves the limit open, else null; -1 where it refuses the text."""
    size = F.octet_length(text).cast("bigint")
    open_case = (size >= max_tokens) & (size < max_tokens * tokenizer.longest_token_bytes())
    return token_count(F.when(open_case, text), tokenizer)


def filter_max_tokens(
    df: DataFrame,
    max_tokens: int = FILTER_MAX_TOKENS,
    text: str = "text",
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """Keep texts with fewer than `max_tokens` tokens (strict); null texts go."""
    return df.where(F.col(text).isNotNull() & below_limit(F.col(text), max_tokens, tokenizer))


def fate(
    text: Column,
    max_tokens: int = FILTER_MAX_TOKENS,
    tokenizer: Tokenizer | None = None,
) -> Column:
    """What the filter does with a row: one of `FATES`."""
    special = has_special_token(text, tokenizer.special_names if tokenizer else None)
    if tokenizer:
        special = special | F.coalesce(_counted_between(text, max_tokens, tokenizer) < 0, F.lit(False))
    return (
        F.when(text.isNull(), "missing")
        .when(special, "special")
        .when(below_limit(text, max_tokens, tokenizer), "kept")
        .otherwise("over_limit")
    )


def fate_counters(fate_column: Column) -> list[Column]:
    """The report's aggregates over a fate column."""
    return [
        F.count(F.lit(1)).alias("processed"),
        F.count_if(fate_column == "missing").alias("skipped"),
        F.count_if(fate_column == "special").alias("skipped_special"),
        F.count_if(fate_column == "kept").alias("kept"),
        F.count_if(fate_column == "over_limit").alias("over_limit"),
    ]


def filter_report(
    df: DataFrame,
    max_tokens: int = FILTER_MAX_TOKENS,
    text: str = "text",
    tokenizer: Tokenizer | None = None,
    by: tuple[str, ...] = (),
) -> DataFrame:
    """Counters of the filter, in one pass; by grouping columns if given."""
    marked = df.select(*by, fate(F.col(text), max_tokens, tokenizer).alias("fate"))
    return marked.groupBy(*by).agg(*fate_counters(F.col("fate")))


def project_pair(
    df: DataFrame,
    source: str,
    target: str,
    source_name: str = SOURCE_COLUMN,
    target_name: str = TARGET_COLUMN,
) -> DataFrame:
    """Exactly two text columns under the given names, null as empty text."""
    return df.select(
        F.coalesce(F.col(source), F.lit("")).alias(source_name),
        F.coalesce(F.col(target), F.lit("")).alias(target_name),
    )


def route_error_rows(
    df: DataFrame,
    on_error: str = "blank",
    source: str = SOURCE_COLUMN,
    target: str = TARGET_COLUMN,
    status: str = "status",
) -> DataFrame:
    """Failed rows stay in place: both texts blank, or the source kept (`keep_source`)."""
    if on_error not in ("blank", "keep_source"):
        raise ValueError(f"unknown on_error: {on_error}")
    failed = F.col(status) == "error"
    routed = df.withColumn(target, F.when(failed, "").otherwise(F.col(target)))
    if on_error == "blank":
        routed = routed.withColumn(source, F.when(failed, "").otherwise(F.col(source)))
    return routed
