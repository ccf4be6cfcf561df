"""Token counts: a native estimate and a tokenizer-backed count.

The two are never mixed: every operator takes a `tokenizer`, and `None` means
the estimate.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from bitextloom.defaults import BYTES_PER_TOKEN, ENCODING_NAME, MAX_COMPLETION_TOKENS
from bitextloom.functions.numbers import int_div
from bitextloom.functions.text import has_special_token, prompt_turns, special_token_names

FAILED = -1
PLAIN_PATTERN = r"\S+|\s+"


def estimate_tokens(text: Column) -> Column:
    """Estimated tokens: 0 for null or empty, else a third of the UTF-8 bytes, at least 1."""
    size = F.octet_length(text).cast("bigint")
    return F.when(F.coalesce(size, F.lit(0)) == 0, F.lit(0).cast("bigint")).otherwise(
        F.greatest(F.lit(1).cast("bigint"), int_div(size, BYTES_PER_TOKEN))
    )


def prompt_base_tokens() -> int:
    """Estimated tokens of the prompt around an empty text."""
    joined = "\n".join(content for _, content in prompt_turns(""))
    return max(1, len(joined.encode("utf-8")) // BYTES_PER_TOKEN)


def estimate_request_tokens(text: Column, max_completion_tokens: int = MAX_COMPLETION_TOKENS) -> Column:
    """Tokens one model call may use: prompt, text and completion allowance."""
    fixed = prompt_base_tokens() + max_completion_tokens
    return F.greatest(F.lit(1).cast("bigint"), estimate_tokens(text) + F.lit(fixed).cast("bigint"))


@dataclass(frozen=True)
class Tokenizer:
    """A byte-pair encoding that executors load for themselves.

    Give either the `name` of an encoding the tokenizer package can load, or a
    `rank_file` (base64 token and rank per line) with its split `pattern`. A
    rank file is a path all executors see, or the name of a file shipped with
    `SparkContext.addFile`. `merges` builds a small encoding from the 256 bytes
    plus the given byte sequences; with none, the count is the byte length.
    """

    name: str = ENCODING_NAME
    rank_file: str | None = None
    pattern: str | None = None
    merges: tuple[bytes, ...] | None = None
    special_names: tuple[str, ...] | None = None

    def __post_init__(self) -> None:
        if self.rank_file is not None and self.pattern is None:
            raise ValueError("a rank file needs the pattern its encoding splits text by")

    def specials(self) -> list[str]:
        return list(self.special_names) if self.special_names is not None else special_token_names()

    def load(self):
        return _load_encoding(self)

    def split_pattern(self) -> str:
        """The pattern that cuts texts into pieces, none of which a token crosses, with Unicode classes for the engine's regexes."""
        pattern = self.pattern or (PLAIN_PATTERN if self.merges is not None else self.load()._pat_str)
        return f"(?U){pattern}"

    def longest_token_bytes(self) -> int:
        """Bytes of the longest token: a text of n bytes has at least n / this tokens."""
        return max(len(token) for token in self.load().token_byte_values())


@lru_cache(maxsize=4)
def _load_encoding(tokenizer: Tokenizer):
    import tiktoken

    if tokenizer.merges is not None:
        tokens = [bytes([b]) for b in range(256)] + list(tokenizer.merges)
        ranks = {token: rank for rank, token in enumerate(tokens)}
    elif tokenizer.rank_file is not None:
        ranks = _read_ranks(tokenizer.rank_file)
    else:
        return tiktoken.get_encoding(tokenizer.name)
    specials = {name: len(ranks) + i for i, name in enumerate(tokenizer.specials())}
    return tiktoken.Encoding(
        name=tokenizer.name,
        pat_str=tokenizer.pattern or PLAIN_PATTERN,
        mergeable_ranks=ranks,
        special_tokens=specials,
    )


def _read_ranks(path: str) -> dict[bytes, int]:
    from pathlib import Path

    from pyspark import SparkFiles

    file = Path(path)
    if not file.exists():
        file = Path(SparkFiles.get(path))
    with file.open("rb") as lines:
        pairs = (line.split() for line in lines if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def byte_tokenizer(merges: Iterable[bytes] = ()) -> Tokenizer:
    """An encoding that needs no rank file: single bytes plus `merges`."""
    return Tokenizer(name="bytes", merges=tuple(merges))


def token_count(text: Column, tokenizer: Tokenizer) -> Column:
    """Tokens of a text; 0 for empty, null for null, -1 where the encoding refuses it.

    Texts that embed a special token are refused; they are found before Python,
    so the encoder need not search each text for a thousand names. One encoder
    per Python worker, texts arrive in Arrow batches.
    """

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encode = tokenizer.load().encode_ordinary

        def size(value: str | None) -> int | None:
            if value is None:
                return None
            try:
                return len(encode(value))
            except Exception:  # any other refusal counts as a failed text, never as a failed job
                return FAILED

        for batch in batches:
            yield pd.Series([size(value) for value in batch], dtype="Int64")

    refused = has_special_token(text, tokenizer.special_names)
    return F.when(refused, F.lit(FAILED).cast("bigint")).otherwise(count(F.when(~refused, text)))


def count_tokens(text: Column, tokenizer: Tokenizer | None = None) -> Column:
    """Estimate when no tokenizer is given, else the tokenizer's count."""
    return estimate_tokens(text) if tokenizer is None else token_count(text, tokenizer)
