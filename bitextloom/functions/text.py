"""Text classification and prompt columns, all JVM-side."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitextloom.defaults import EXAMPLE_TURNS, RESERVED_RANGES, SPECIAL_NAMES, SYSTEM_PROMPT

MISSING, EMPTY, SPECIAL, OK = "missing", "empty", "special", "ok"


def special_token_names() -> list[str]:
    """Names of the encoding's special tokens, as they appear in text."""
    reserved = (f"reserved_{n}" for low, high in RESERVED_RANGES for n in range(low, high + 1))
    return [f"<|{name}|>" for name in (*SPECIAL_NAMES, *reserved)]


def special_token_pattern(names: Iterable[str] | None = None) -> str:
    """One regular expression that finds any special token."""
    if names is not None:
        # Without names nothing matches; an empty expression would match everything.
        return "|".join(re.escape(name) for name in names) or "(?!)"
    reserved = "|".join(str(n) for low, high in RESERVED_RANGES for n in range(low, high + 1))
    return r"<\|(?:" + "|".join(SPECIAL_NAMES) + "|reserved_(?:" + reserved + r"))\|>"


def has_special_token(text: Column, names: Iterable[str] | None = None) -> Column:
    """True where the text embeds a special token; false for null.

    The byte search for the opening mark is far cheaper than the expression,
    and nearly every text stops there.
    """
    found = text.rlike(special_token_pattern(names))
    if names is None:
        found = F.contains(text, F.lit("<|")) & found
    return F.coalesce(found, F.lit(False))


def is_blank_text(text: Column) -> Column:
    """True for a null or empty text: such rows need no model call."""
    return F.coalesce(text, F.lit("")) == ""


def normalize_null(text: Column) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(text, F.lit(""))


def text_class(text: Column, names: Iterable[str] | None = None) -> Column:
    """Exclusive class of a text: missing, empty, special or ok, in that order."""
    return (
        F.when(text.isNull(), MISSING)
        .when(text == "", EMPTY)
        .when(has_special_token(text, names), SPECIAL)
        .otherwise(OK)
    )


def prompt_turns(text: str) -> list[tuple[str, str]]:
    """The prompt as (role, content) pairs for one text."""
    return [("system", SYSTEM_PROMPT), *EXAMPLE_TURNS, ("user", text)]


def build_messages(text: Column) -> Column:
    """The prompt as `array<struct<role,content>>`: system, two examples, the text."""

    def turn(role: str, content: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), content.alias("content"))

    fixed = [turn(role, F.lit(content)) for role, content in prompt_turns("")[:-1]]
    return F.array(*fixed, turn("user", text))
