"""Scans, paths, positions, counts and run state."""

from bitextloom.sources.counts import (
    cached_count,
    count_new_files,
    count_rows_jsonl,
    count_rows_parquet,
    counted_files,
    footer_count,
    pushdown,
    resolve_max_samples,
    rows_per_file,
    unreadable_files,
)
from bitextloom.sources.paths import (
    expand_paths,
    include_patterns,
    infer_format,
    infer_format_column,
    is_directory,
    list_files,
)
from bitextloom.sources.positions import (
    file_offsets,
    first_jsonl_rows,
    global_ordinal,
    rows_between,
    scan_from_offset,
    stage_jsonl,
    take_first_rows,
)
from bitextloom.sources.readers import (
    parse_jsonl,
    resolve_text_field,
    scan_corpus,
    scan_jsonl,
    scan_parquet,
    stream_jsonl,
    union_sources,
    with_text,
)
from bitextloom.sources.state import StateLog

__all__ = [name for name in dir() if not name.startswith("_")]
