"""Rate-limit resolution: argument over environment over tier table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from bitextloom.defaults import FALLBACK_TIER, RATE_TIERS


@dataclass(frozen=True)
class Limits:
    """Requests and tokens allowed in any 60 seconds."""

    rpm: int
    tpm: int

    def split(self, parts: int) -> "Limits":
        """The share of one of `parts` tasks."""
        return Limits(max(1, self.rpm // parts), max(1, self.tpm // parts))


def _whole_number(text: str) -> int | None:
    try:
        return int(text)
    except ValueError:
        return None


def _pick(argument: int | None, override: str, tier_value: int) -> int:
    given = _whole_number(override) if argument is None else argument
    return max(1, given or tier_value)


def resolve_limits(
    tier: str = FALLBACK_TIER,
    rpm: int | None = None,
    tpm: int | None = None,
    env_rpm: str = "",
    env_tpm: str = "",
) -> Limits:
    """Effective limits; an unreadable override is ignored, 0 means the tier's value."""
    table = {name: (tier_rpm, tier_tpm) for name, tier_rpm, tier_tpm in RATE_TIERS}
    tier_rpm, tier_tpm = table.get(str(tier), table[FALLBACK_TIER])
    return Limits(_pick(rpm, env_rpm, tier_rpm), _pick(tpm, env_tpm, tier_tpm))


def tier_limit(tier: Column, which: str) -> Column:
    """The tier table's `rpm` or `tpm` as a column; an unknown tier counts as the first."""
    position = {"rpm": 1, "tpm": 2}[which]
    values = {row[0]: row[position] for row in RATE_TIERS}
    picked = F.lit(values[FALLBACK_TIER]).cast("bigint")
    for name, value in values.items():
        picked = F.when(tier == name, F.lit(value).cast("bigint")).otherwise(picked)
    return picked


def resolve_limit_column(argument: Column, override: Column, tier: Column, which: str) -> Column:
    """Column form of `resolve_limits` for one of the two limits."""
    given = F.when(argument.isNotNull(), argument.cast("bigint")).otherwise(
        F.trim(override).try_cast("bigint")
    )
    chosen = F.coalesce(F.nullif(given, F.lit(0).cast("bigint")), tier_limit(tier, which))
    return F.greatest(F.lit(1).cast("bigint"), chosen)
