"""Checked queries: filter report, profile, rate plan and rate audit."""

from pyspark.sql import functions as F

from bitextloom.catalog.registry import (
    CLASSED,
    EDGE,
    REQUEST_FIXED,
    SPECIAL,
    TOKENS,
    documents,
    edge_documents,
    query,
    table,
)
from bitextloom.functions import byte_tokenizer, epoch_micros, int_div
from bitextloom.functions.rates import Limits
from bitextloom.operators.filters import filter_report
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
from bitextloom.operators.sketches import rank_error, sketch_percentiles, store_sketches, stored_sketches, token_sketches
from bitextloom.session import scratch_path

COUNTERS = f"""count(*) AS processed, count(*) FILTER (WHERE text IS NULL) AS skipped,
  count(*) FILTER (WHERE text IS NOT NULL AND {SPECIAL}) AS skipped_special,
  count(*) FILTER (WHERE text IS NOT NULL AND NOT {SPECIAL} AND {TOKENS} < 512) AS kept,
  count(*) FILTER (WHERE text IS NOT NULL AND NOT {SPECIAL} AND {TOKENS} >= 512) AS over_limit"""


def frequencies(spark, sf_dir, by=()):
    return token_frequencies(edge_documents(spark, sf_dir), by=by)


@query("filter_report", f"WITH {EDGE} SELECT {COUNTERS} FROM edge")
def filter_report_query(spark, sf_dir):
    return filter_report(edge_documents(spark, sf_dir))


@query("filter_report_by_lang", f"WITH {EDGE} SELECT lang, {COUNTERS} FROM edge GROUP BY lang")
def filter_report_by_lang_query(spark, sf_dir):
    return filter_report(edge_documents(spark, sf_dir), by=("lang",))


@query(
    "quality_counts",
    f"""WITH {CLASSED} SELECT count(*) AS samples, count(*) FILTER (WHERE kind = 'missing') AS missing_text,
        count(*) FILTER (WHERE kind = 'empty') AS empty_text, count(*) FILTER (WHERE kind = 'special') AS skipped_special FROM counted""",
)
def quality_counts_query(spark, sf_dir):
    return quality_counts(frequencies(spark, sf_dir))


@query(
    "token_min_max_mean",
    f"WITH {CLASSED} SELECT min(n) AS min_tokens, max(n) AS max_tokens, round(avg(n), 6) AS mean_tokens FROM counted",
)
def token_min_max_mean_query(spark, sf_dir):
    return token_min_max_mean(frequencies(spark, sf_dir))


PERCENTILES = ", ".join(f"round(quantile_cont(n, {p / 100}), 6) AS p{p}" for p in (50, 90, 95, 99))


@query("token_percentiles", f"WITH {CLASSED} SELECT {PERCENTILES} FROM counted")
def token_percentiles_query(spark, sf_dir):
    return token_percentiles(frequencies(spark, sf_dir))


SUMMARY = f"""count(*) AS samples, count(*) FILTER (WHERE kind = 'missing') AS missing_text,
  count(*) FILTER (WHERE kind = 'empty') AS empty_text, count(*) FILTER (WHERE kind = 'special') AS skipped_special,
  min(n) AS min_tokens, max(n) AS max_tokens, round(avg(n), 6) AS mean_tokens, {PERCENTILES}"""


@query("profile_summary", f"WITH {CLASSED} SELECT {SUMMARY} FROM counted")
def profile_summary_query(spark, sf_dir):
    return profile_summary(frequencies(spark, sf_dir))


@query("token_class_by", f"WITH {CLASSED} SELECT lang, source, {SUMMARY} FROM counted GROUP BY lang, source")
def token_class_by_query(spark, sf_dir):
    by = ("lang", "source")
    return profile_summary(frequencies(spark, sf_dir, by), by)


@query(
    "profile_encoded",
    f"""WITH {CLASSED}, bytes AS (SELECT kind, CASE WHEN kind = 'ok' THEN strlen(text) ELSE 0 END AS n FROM counted)
        SELECT {SUMMARY} FROM bytes""",
)
def profile_encoded_query(spark, sf_dir):
    """The profile on an encoder's counts instead of the estimate."""
    return profile_summary(token_frequencies(edge_documents(spark, sf_dir), tokenizer=byte_tokenizer()))


@query(
    "sketch_percentiles",
    f"""WITH {CLASSED} SELECT lang, count(*) AS samples, min(n) AS min_tokens, max(n) AS max_tokens, true AS p50_within, true AS p90_within,
        true AS p99_within FROM counted GROUP BY lang""",
)
def sketch_percentiles_query(spark, sf_dir):
    """Sketches of a fifth of each language, stored and merged; their percentiles lie within the bound of the exact ranks."""
    path, rows = scratch_path(spark, "sketches"), edge_documents(spark, sf_dir)
    part = F.concat_ws("/", F.coalesce("lang", F.lit("")), (F.col("doc_id") % 5).cast("string"))
    store_sketches(token_sketches(rows, part), path)
    lang = F.nullif(F.substring_index("part", "/", 1), F.lit("")).alias("lang")
    merged = sketch_percentiles(stored_sketches(spark, path).select(lang, "samples", "sketch"), ("lang",))
    freq = token_frequencies(rows, by=("lang",)).withColumnRenamed("lang", "_lang")
    joined = freq.join(F.broadcast(merged), F.col("_lang").eqNullSafe(F.col("lang")))
    names = ("p50", "p90", "p99")
    ranks = [F.sum(F.when(F.col("n_tokens") < F.col(p), F.col("cnt")).otherwise(0)) for p in names]
    upto = [F.sum(F.when(F.col("n_tokens") <= F.col(p), F.col("cnt")).otherwise(0)) for p in names]
    slack = F.col("samples") * rank_error() + 1
    checks = [
        ((low <= F.col("samples") * int(p[1:]) / 100 + slack) & (high >= F.col("samples") * int(p[1:]) / 100 - slack)).alias(f"{p}_within")
        for p, low, high in zip(names, ranks, upto)
    ]
    return joined.groupBy("lang", "samples", "min_tokens", "max_tokens").agg(*checks)


BUCKETS = f"""{CLASSED}, filled AS (SELECT n // 200 AS bucket, count(*) AS cnt FROM counted GROUP BY 1),
  spine AS (SELECT unnest(generate_series(0::BIGINT, (SELECT max(bucket) FROM filled))) AS bucket),
  bars AS (SELECT bucket, coalesce(cnt, 0) AS cnt FROM spine LEFT JOIN filled USING (bucket))"""


@query("histogram_zero_fill", f"WITH {BUCKETS} SELECT bucket, cnt FROM bars")
def histogram_zero_fill_query(spark, sf_dir):
    return histogram_zero_fill(bucket_counts(frequencies(spark, sf_dir))).select("bucket", "cnt")


@query(
    "token_histogram",
    f"""WITH {BUCKETS} SELECT bucket * 200 AS bucket_start, bucket * 200 + 199 AS bucket_end, cnt,
        round(cnt * 100.0::DOUBLE / (SELECT count(*) FROM documents), 6) AS pct FROM bars""",
)
def token_histogram_query(spark, sf_dir):
    return token_histogram(frequencies(spark, sf_dir))


@query(
    "tier_plan",
    f"""WITH {EDGE}, sized AS (SELECT {REQUEST_FIXED} + {TOKENS} AS n FROM edge WHERE coalesce(text, '') <> ''),
        total AS (SELECT count(*) AS requests, CAST(sum(n) AS BIGINT) AS tokens FROM sized),
        tiers(tier, rpm, tpm) AS (VALUES ('1', 500::BIGINT, 200000::BIGINT), ('2', 5000, 2000000), ('3', 5000, 4000000),
          ('4', 10000, 10000000), ('5', 30000, 180000000)),
        rated AS (SELECT tier, requests, tokens,
          CAST(greatest(1, least(rpm, floor(tpm / (tokens / requests)))) AS BIGINT) AS requests_per_minute FROM total, tiers)
        SELECT *, round(requests / requests_per_minute, 6) AS min_minutes FROM rated""",
)
def tier_plan_query(spark, sf_dir):
    return tier_plan(request_totals(edge_documents(spark, sf_dir)))


AUDIT_LIMITS = Limits(rpm=2, tpm=200)


@query(
    "rate_window_usage",
    """WITH log AS (SELECT event_id, event_type AS backend, ts, greatest(1, least(user_id, 200)) AS tokens FROM events),
       used AS (SELECT event_id, backend, count(*) OVER w AS requests_60s, CAST(sum(tokens) OVER w AS BIGINT) AS tokens_60s
                FROM log WINDOW w AS (PARTITION BY backend ORDER BY ts
                  RANGE BETWEEN INTERVAL 59999999 MICROSECONDS PRECEDING AND CURRENT ROW))
       SELECT *, requests_60s > 2 OR tokens_60s > 200 AS over_budget FROM used""",
)
def rate_window_usage_query(spark, sf_dir):
    """Events as a request log: the type is the backend, the user number the tokens."""
    log = table(spark, sf_dir, "events").select(
        "event_id", F.col("event_type").alias("backend"), "ts", F.col("user_id").alias("tokens")
    )
    return rate_window_usage(log, AUDIT_LIMITS).drop("ts", "tokens")


@query(
    "rate_window_usage_dense",
    """WITH log AS (SELECT event_id, event_type AS backend, epoch_us(ts) // 10000 AS us, greatest(1, least(user_id, 200)) AS tokens FROM events),
       used AS (SELECT event_id, backend, count(*) OVER w AS requests_60s, CAST(sum(tokens) OVER w AS BIGINT) AS tokens_60s
                FROM log WINDOW w AS (PARTITION BY backend ORDER BY us RANGE BETWEEN 59999999 PRECEDING AND CURRENT ROW))
       SELECT *, requests_60s > 2 OR tokens_60s > 200 AS over_budget FROM used""",
)
def rate_window_usage_dense_query(spark, sf_dir):
    """The same log with time pressed ten-thousandfold, so that windows hold hundreds of rows."""
    events = table(spark, sf_dir, "events")
    squeezed = int_div(epoch_micros(F.col("ts"), dict(events.dtypes)["ts"]), 10_000).alias("ts")
    log = events.select(
        "event_id", F.col("event_type").alias("backend"), squeezed, F.col("user_id").alias("tokens")
    )
    return rate_window_usage(log, AUDIT_LIMITS).drop("ts", "tokens")


SERVERS = ["http://localhost:8000/v1", "http://localhost:8001/v1", "http://localhost:8002/v1"]


@query(
    "round_robin_assign",
    """SELECT doc_id, CASE WHEN doc_id % 104 < 100 THEN 'gpt-oss' ELSE 'openai-api' END AS backend,
              'http://localhost:800' || (doc_id % 3) || '/v1' AS endpoint FROM documents""",
)
def round_robin_assign_query(spark, sf_dir):
    weights = {"gpt-oss": 100, "openai-api": 4}
    assigned = round_robin_assign(documents(spark, sf_dir), weights, "doc_id")
    return assigned.select("doc_id", "backend", endpoint_of(F.col("doc_id"), SERVERS).alias("endpoint"))
