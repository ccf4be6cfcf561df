"""Text layout of the reports; the numbers come from one-row or bucket tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

# The wording, order and widths of the report's lines, which readers of the reports rely on.


def format_filter_report(row: Mapping) -> str:
    """Counters of the filter, one per line."""
    return "\n".join(f"{name}: {row[name]}" for name in ("processed", "skipped", "skipped_special", "kept"))


def format_profile_report(summary: Mapping, histogram: Iterable[Mapping]) -> str:
    """The profile: quality counters, range, percentiles, histogram lines."""
    counters = [
        f"{name}: {summary[name]}" for name in ("samples", "missing_text", "empty_text", "skipped_special")
    ]
    extent = "min: {min_tokens} max: {max_tokens} mean: {mean_tokens:.2f}".format_map(summary)
    points = " ".join(f"p{p}: {summary[f'p{p}']:.1f}" for p in (50, 90, 95, 99))
    bars = [
        "{bucket_start:>6}-{bucket_end:<6} {cnt:>6} ({pct:>5.1f}%)".format_map(bucket) for bucket in histogram
    ]
    return "\n".join([*counters, extent, points, "histogram:", *bars])
