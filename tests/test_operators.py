import random

import pytest
from pyspark.sql import functions as F

from bitextloom.functions import byte_tokenizer
from bitextloom.operators import (
    pending_ranges,
    bucket_counts,
    filter_cap,
    filter_max_tokens,
    filter_report,
    first_rows_by_key,
    histogram_zero_fill,
    nth_key,
    profile_cap,
    profile_summary,
    project_pair,
    route_error_rows,
    token_frequencies,
    token_histogram,
)
from bitextloom.operators import caps as caps_module


def test_limit_is_strict(texts):
    df = texts("x" * 29, "x" * 30, "", None)
    assert [row["row_id"] for row in filter_max_tokens(df, 10).collect()] == [0, 2]


def test_encoded_filter_decides_by_length_and_by_count(texts):
    """One byte below, at, and above the bounds, and texts only the encoder can decide."""
    df = texts("a" * 9, "a" * 10, "th" * 9, "th" * 10, "th" * 11, "a" * 40, None, "")
    kept = filter_max_tokens(df, 10, tokenizer=byte_tokenizer([b"th"]))
    assert [row["row_id"] for row in kept.collect()] == [0, 2, 7]


def test_filter_report_accounts_for_every_row(texts):
    df = texts(None, "", "ok", "<|end|>", "long" * 500)
    row = filter_report(df, 512).first()
    assert tuple(row) == (5, 1, 1, 2, 1)
    assert row["processed"] == row["skipped"] + row["skipped_special"] + row["kept"] + row["over_limit"]


def test_error_rows_stay_in_place(spark):
    rows = [("a", "x", "ok"), ("b", "y", "error")]
    df = spark.createDataFrame(rows, "text_en string, text_ja string, status string")
    assert [tuple(r) for r in route_error_rows(df).collect()] == [("a", "x", "ok"), ("", "", "error")]
    kept = route_error_rows(df, "keep_source").collect()
    assert [tuple(r) for r in kept] == [("a", "x", "ok"), ("b", "", "error")]
    with pytest.raises(ValueError):
        route_error_rows(df, "drop")


def test_project_pair_names(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    pair = project_pair(df, "x", "y", "en", "ja")
    assert pair.columns == ["en", "ja"] and tuple(pair.first()) == ("a", "")


def test_nth_key_narrows_to_the_exact_key(spark, monkeypatch):
    monkeypatch.setattr(caps_module, "RANGES", 4)
    monkeypatch.setattr(caps_module, "SORT_ROWS", 3)
    keys = random.Random(5).sample(range(-10_000, 1_000_000), 200) + [2**40]
    df = spark.createDataFrame([(k,) for k in keys] + [(None,)], "k bigint")
    ordered = sorted(keys)
    for n in (1, 2, 57, 200, 201):
        assert nth_key(df, "k", n) == ordered[n - 1]
    assert nth_key(df, "k", 202) is None
    assert sorted(r["k"] for r in first_rows_by_key(df, "k", 57).collect()) == ordered[:57]


def test_a_key_shared_across_the_cut_is_an_error(spark):
    df = spark.createDataFrame([(1,), (2,), (2,), (3,)], "k bigint")
    assert first_rows_by_key(df, "k", 3).count() == 3
    with pytest.raises(ValueError):
        first_rows_by_key(df, "k", 2)


def test_cap_rules(texts, spark):
    df = texts("a", None, "b")
    assert profile_cap(df, "row_id", -1).count() == profile_cap(df, "row_id", 0).count() == 0
    assert filter_cap(df, "row_id", -1).count() == 3
    assert filter_cap(df, "row_id", 2).where("text IS NOT NULL").count() == 1
    assert filter_cap(df, "row_id", 10).count() == 3
    with pytest.raises(TypeError):
        nth_key(df, "text", 1)


def frequencies(spark, counts):
    rows = [("ok", n, 1) for n in counts]
    return spark.createDataFrame(rows, "text_class string, n_tokens bigint, cnt bigint")


def test_percentiles_interpolate(spark):
    row = profile_summary(frequencies(spark, [1, 2, 3, 4, 10, 11, 50])).first()
    assert [row[p] for p in ("p50", "p90", "p95", "p99")] == [4.0, 26.6, 38.3, 47.66]
    assert (row["min_tokens"], row["max_tokens"], row["mean_tokens"]) == (1, 50, 11.571429)


def test_empty_profile_is_all_zeros(spark):
    row = profile_summary(frequencies(spark, [])).first()
    assert set(row.asDict().values()) == {0}
    assert [tuple(r) for r in token_histogram(frequencies(spark, []), 200).collect()] == [(0, 199, 0, 0.0)]


def test_histogram_fills_gaps(spark, monkeypatch):
    from bitextloom.operators import profile

    monkeypatch.setattr(profile, "SPINE_RUN", 3)
    freq = frequencies(spark, [0, 5, 5, 9, 95])
    rows = token_histogram(freq, 10).orderBy("bucket_start").collect()
    assert [tuple(r) for r in rows[:2]] == [(0, 9, 4, 80.0), (10, 19, 0, 0.0)]
    assert len(rows) == 10 and sum(r["cnt"] for r in rows) == 5
    assert histogram_zero_fill(bucket_counts(freq, 10)).count() == 10
    for size in (0, -1):
        with pytest.raises(ValueError):
            token_histogram(freq, size)


def test_profile_does_not_depend_on_partitions(texts):
    values = [None, "", "<|end|>"] + ["x" * (i * 7 % 50) for i in range(100)]
    df = texts(*values)
    one = profile_summary(token_frequencies(df.coalesce(1))).first()
    many = profile_summary(token_frequencies(df.orderBy(F.desc("row_id")).repartition(7))).first()
    assert one == many and one["p50"] <= one["p90"] <= one["p95"] <= one["p99"]
    assert one["samples"] == 103 and one["missing_text"] == 1 and one["skipped_special"] == 1


def test_encoded_profile_classes(texts):
    df = texts(None, "", "<|end|>", "abcd")
    row = profile_summary(token_frequencies(df, tokenizer=byte_tokenizer())).first()
    assert (row["samples"], row["missing_text"], row["empty_text"], row["skipped_special"]) == (4, 1, 1, 1)
    assert row["max_tokens"] == 4 and row["mean_tokens"] == 1.0


def plain_gaps(done, end, size):
    covered = bytearray(end)
    for first, last in done:
        first, last = max(0, first), min(end, last)
        if last > first:
            covered[first:last] = b"\1" * (last - first)
    gaps, at = [], 0
    while at < end:
        if covered[at]:
            at = covered.find(0, at)
            at = end if at < 0 else at
            continue
        stop = covered.find(1, at)
        stop = end if stop < 0 else stop
        gaps += [(a, min(a + size, stop)) for a in range(at, stop, size)]
        at = stop
    return gaps


@pytest.mark.parametrize(
    ("done", "end", "size"),
    [([], 10, 3), ([], 0, 3), ([(0, 10)], 10, 3), ([(2, 4), (2, 4), (3, 9)], 12, 2), ([(-5, 2), (20, 30), (4, 4), (7, 5)], 9, 100),
     ([(0, 9000), (8000, 8001), (8999, 9001)], 20_000, 700), ([(5, 6)], 7, 1)],
)
def test_pending_ranges(spark, done, end, size):
    rows = spark.createDataFrame(done, "first long, last long")
    assert sorted(map(tuple, pending_ranges(rows, end, size).collect())) == plain_gaps(done, end, size)


def test_a_million_overlapping_ranges(spark):
    end = 30_000_000
    start = F.pmod(F.xxhash64("id"), F.lit(end))
    length = F.pmod(F.xxhash64("id", F.lit(1)), F.when(F.col("id") % 1000 == 0, 5000).otherwise(40))
    rows = spark.range(1_000_000).select(start.alias("first"), (start + length).alias("last"))
    found = pending_ranges(rows, end, 64)
    table = rows.toPandas()
    assert sorted(map(tuple, found.collect())) == plain_gaps(list(zip(table["first"], table["last"])), end, 64)
    assert "CollectLimit" not in found._jdf.queryExecution().executedPlan().toString()
