"""DataFrame operators."""

from bitextloom.operators.backends import (
    Backend,
    ChatBackend,
    FaultyBackend,
    PrefixBackend,
    api_chat,
    local_chat,
)
from bitextloom.operators.caps import (
    filter_cap,
    first_rows_by_key,
    nth_key,
    profile_cap,
    translate_cap,
)
from bitextloom.operators.enrich import (
    Budget,
    budget_slots,
    calling_profile,
    enrich_report,
    enrich_text,
    enrich_to_table,
    hybrid_enrich,
    rate_budgeted_enrich,
)
from bitextloom.operators.filters import (
    drop_missing_text,
    drop_special_token_text,
    fate,
    filter_max_tokens,
    filter_report,
    project_pair,
    route_error_rows,
)
from bitextloom.operators.profile import (
    bucket_counts,
    histogram_zero_fill,
    profile_summary,
    quality_counts,
    token_frequencies,
    token_histogram,
    token_min_max_mean,
    token_percentiles,
)
from bitextloom.operators.rates import (
    endpoint_of,
    rate_window_usage,
    request_totals,
    round_robin_assign,
    tier_plan,
)
from bitextloom.operators.resume import (
    existing_rows,
    next_shard_number,
    pending_ranges,
    reassemble_in_order,
    resume_pending,
)
from bitextloom.operators.sketches import (
    rank_error,
    sketch_percentiles,
    store_sketches,
    stored_sketches,
    token_sketches,
)
from bitextloom.operators.word_tokens import token_counts, word_table

__all__ = [name for name in dir() if not name.startswith("_")]
