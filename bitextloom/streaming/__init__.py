"""Incremental runs on Structured Streaming."""

from bitextloom.streaming.appended import AppendedLines, numbered_lines, process_appended
from bitextloom.streaming.incremental import (
    incremental_enrich,
    incremental_filter,
    live_progress,
    read_new_files,
)
from bitextloom.streaming.watch import RunWatch, run_state, wait_for_stop

__all__ = [name for name in dir() if not name.startswith("_")]
