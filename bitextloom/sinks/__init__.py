"""Parquet sinks and report layouts."""

from bitextloom.sinks.parquet import (
    number_shards,
    parse_size,
    reshard_for_publish,
    shard_manifest,
    write_by_rows,
    write_by_size,
    write_ordered,
)
from bitextloom.sinks.report import format_filter_report, format_profile_report

__all__ = [name for name in dir() if not name.startswith("_")]
