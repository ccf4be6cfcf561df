"""Column functions."""

from bitextloom.functions.numbers import bucket_of, epoch_micros, int_div, pct_of_total
from bitextloom.functions.rates import Limits, resolve_limit_column, resolve_limits, tier_limit
from bitextloom.functions.retry import (
    is_rate_limit_error,
    parse_retry_after,
    rate_limit_wait,
    retry_delay,
)
from bitextloom.functions.shards import next_shard_id, shard_name, shard_number
from bitextloom.functions.text import (
    build_messages,
    has_special_token,
    is_blank_text,
    normalize_null,
    special_token_names,
    special_token_pattern,
    text_class,
)
from bitextloom.functions.tokens import (
    Tokenizer,
    byte_tokenizer,
    count_tokens,
    estimate_request_tokens,
    estimate_tokens,
    prompt_base_tokens,
    token_count,
)

__all__ = [name for name in dir() if not name.startswith("_")]
