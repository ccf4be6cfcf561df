"""Error-message columns and their per-row counterparts used inside tasks."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitextloom.defaults import (
    DEFAULT_RETRY_AFTER_SECONDS,
    MAX_RETRIES,
    RETRY_AFTER_MS_PATTERN,
    RETRY_AFTER_S_PATTERN,
    RETRY_STEP_SECONDS,
)


def parse_retry_after(message: Column) -> Column:
    """Seconds an error message asks to wait; null when it names none.

    A millisecond wait anywhere in the message wins over a wait in seconds.
    """
    millis = F.regexp_extract(message, RETRY_AFTER_MS_PATTERN, 1).try_cast("double")
    seconds = F.regexp_extract(message, RETRY_AFTER_S_PATTERN, 1).try_cast("double")
    return F.coalesce(millis / 1000.0, seconds)


def rate_limit_wait(message: Column) -> Column:
    """Wait before the next try after a rate limit: none named, or 0, means one second."""
    wait = parse_retry_after(message)
    return F.when(wait > 0, wait).otherwise(F.lit(DEFAULT_RETRY_AFTER_SECONDS))


def is_rate_limit_error(message: Column) -> Column:
    """True where an error message speaks of a rate limit."""
    return F.coalesce(
        F.contains(F.lower(message), F.lit("rate limit")) | F.contains(message, F.lit("429")),
        F.lit(False),
    )


def retry_delay(attempt: Column, max_retries: int = MAX_RETRIES) -> Column:
    """Seconds to wait after failed try number `attempt` (from 0); null when tries are used up."""
    return F.when(attempt < max_retries, (attempt + 1) * F.lit(RETRY_STEP_SECONDS))


# Per-row forms, for use inside a task where the message exists only in Python.


def rate_limited(error: str | Exception) -> bool:
    """A message that speaks of a rate limit, or an error whose type or status code says so whatever its message."""
    message = str(error)
    typed = type(error).__name__ == "RateLimitError" or getattr(error, "status_code", None) == 429
    return typed or "429" in message or "rate limit" in message.lower()


def wait_from_message(message: str) -> float:
    for pattern, unit in ((RETRY_AFTER_MS_PATTERN, 1000.0), (RETRY_AFTER_S_PATTERN, 1.0)):
        found = re.search(pattern, message)
        if found:
            try:
                return float(found.group(1)) / unit or DEFAULT_RETRY_AFTER_SECONDS
            except ValueError:
                break
    return DEFAULT_RETRY_AFTER_SECONDS
