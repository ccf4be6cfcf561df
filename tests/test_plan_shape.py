"""The plans, not the results: what is shuffled, pushed down and opened."""

import io
from contextlib import redirect_stdout

import pytest
from pyspark.sql import functions as F

from bitextloom.functions import byte_tokenizer, estimate_tokens
from bitextloom.operators import (
    PrefixBackend,
    drop_special_token_text,
    enrich_text,
    filter_max_tokens,
    first_rows_by_key,
    hybrid_enrich,
    profile_summary,
    rate_window_usage,
    round_robin_assign,
    token_frequencies,
)
from bitextloom.functions import Limits
from bitextloom.sources import global_ordinal, scan_from_offset, take_first_rows


def plan(df):
    text = io.StringIO()
    with redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.fixture
def corpus(spark, numbered_files):
    return spark.read.parquet(numbered_files).withColumnRenamed("n", "row_id").withColumnRenamed("en_text", "text")


def test_row_operators_do_not_shuffle(corpus):
    frames = [
        filter_max_tokens(corpus, 5),
        filter_max_tokens(drop_special_token_text(corpus), 5, tokenizer=byte_tokenizer()),
        enrich_text(corpus, PrefixBackend()),
        hybrid_enrich(corpus, [PrefixBackend("a"), PrefixBackend("b")]),
        round_robin_assign(corpus, {"a": 1, "b": 2}, "row_id"),
        corpus.select(estimate_tokens(F.col("text"))),
    ]
    for frame in frames:
        assert "Exchange" not in plan(frame)


def test_native_filter_needs_no_python(corpus):
    assert "Python" not in plan(filter_max_tokens(drop_special_token_text(corpus), 5))


def test_null_filter_and_cap_reach_the_reader(corpus):
    assert "IsNotNull(en_text)" in plan(filter_max_tokens(corpus, 5))
    assert "LessThanOrEqual(n," in plan(first_rows_by_key(corpus, "row_id", 10))


def test_only_used_columns_are_read(corpus):
    frequencies = plan(token_frequencies(corpus))
    assert "ReadSchema: struct<en_text:string>" in frequencies


def files_opened(df):
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().get("numFiles").get().value() for i in range(leaves.size()))


def test_positions_skip_files(spark, numbered_files):
    df = spark.read.parquet(numbered_files)
    assert files_opened(scan_from_offset(df, 80)) == 1
    assert files_opened(take_first_rows(df, 10)) == 1
    assert files_opened(df.select("n")) == 5


def test_ordinals_join_by_broadcast_without_moving_rows(spark, numbered_files):
    text = plan(global_ordinal(spark.read.parquet(numbered_files)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_profile_shuffles_partial_counts(corpus):
    text = plan(profile_summary(token_frequencies(corpus)))
    before_first_exchange = text[: text.index("Exchange")]
    assert "partial_count" in text and before_first_exchange.count("HashAggregate") >= 1


def test_rate_audit_groups_by_backend_and_minute(spark):
    log = spark.createDataFrame([("a", 1, 1)], "backend string, ts bigint, tokens bigint")
    text = plan(rate_window_usage(log, Limits(1, 1)))
    assert "hashpartitioning(backend" in text and "minute" in text
    assert "CartesianProduct" not in text and "NestedLoop" not in text
