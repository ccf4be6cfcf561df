"""Checked queries: filters, projections and column functions."""

from pyspark.sql import functions as F

from bitextloom.catalog.registry import (
    EDGE,
    REQUEST_FIXED,
    SPECIAL,
    TOKENS,
    documents,
    edge_documents,
    query,
    table,
)
from bitextloom.functions import (
    bucket_of,
    build_messages,
    byte_tokenizer,
    estimate_request_tokens,
    estimate_tokens,
    is_blank_text,
    is_rate_limit_error,
    normalize_null,
    parse_retry_after,
    pct_of_total,
    rate_limit_wait,
    resolve_limit_column,
    retry_delay,
    shard_name,
)
from bitextloom.operators.filters import (
    drop_missing_text,
    drop_special_token_text,
    filter_max_tokens,
    project_pair,
    route_error_rows,
)
from bitextloom.operators.word_tokens import token_counts


@query("drop_missing_text", f"WITH {EDGE} SELECT doc_id, text FROM edge WHERE text IS NOT NULL")
def drop_missing_text_query(spark, sf_dir):
    return drop_missing_text(edge_documents(spark, sf_dir)).select("doc_id", "text")


@query(
    "filter_max_tokens",
    f"WITH {EDGE} SELECT doc_id, text, CAST({TOKENS} AS BIGINT) AS n_tokens FROM edge WHERE text IS NOT NULL AND {TOKENS} < 512",
)
def filter_max_tokens_query(spark, sf_dir):
    kept = filter_max_tokens(edge_documents(spark, sf_dir), 512)
    return kept.select("doc_id", "text", estimate_tokens(F.col("text")).alias("n_tokens"))


@query(
    "filter_max_tokens_encoded",
    f"WITH {EDGE} SELECT doc_id, text FROM edge WHERE text IS NOT NULL AND NOT {SPECIAL} AND strlen(text) - (strlen(text) - strlen(replace(text, 'th', ''))) // 2 < 1500",
)
def filter_max_tokens_encoded_query(spark, sf_dir):
    """With an encoder of single bytes and one merge, so that SQL can count too."""
    clean = drop_special_token_text(edge_documents(spark, sf_dir))
    return filter_max_tokens(clean, 1500, tokenizer=byte_tokenizer([b"th"])).select("doc_id", "text")


@query("drop_special_token_text", f"WITH {EDGE} SELECT doc_id, text FROM edge WHERE NOT {SPECIAL}")
def drop_special_token_text_query(spark, sf_dir):
    return drop_special_token_text(edge_documents(spark, sf_dir)).select("doc_id", "text")


@query("is_blank_text", f"WITH {EDGE} SELECT doc_id, coalesce(text, '') = '' AS blank FROM edge")
def is_blank_text_query(spark, sf_dir):
    return edge_documents(spark, sf_dir).select("doc_id", is_blank_text(F.col("text")).alias("blank"))


@query("normalize_null", f"WITH {EDGE} SELECT doc_id, coalesce(text, '') AS text FROM edge")
def normalize_null_query(spark, sf_dir):
    return edge_documents(spark, sf_dir).select("doc_id", normalize_null(F.col("text")).alias("text"))


@query("project_pair", f"WITH {EDGE} SELECT coalesce(text, '') AS en, lang AS ja FROM edge")
def project_pair_query(spark, sf_dir):
    return project_pair(edge_documents(spark, sf_dir), "text", "lang", "en", "ja")


@query(
    "route_error_rows",
    """SELECT doc_id, CASE WHEN doc_id % 9 = 0 THEN '' ELSE text END AS text_en,
              CASE WHEN doc_id % 9 = 0 THEN '' ELSE '[ja] ' || text END AS text_ja,
              CASE WHEN doc_id % 9 = 0 THEN 'error' ELSE 'ok' END AS status FROM documents""",
)
def route_error_rows_query(spark, sf_dir):
    rows = documents(spark, sf_dir).select(
        "doc_id",
        F.col("text").alias("text_en"),
        F.concat(F.lit("[ja] "), "text").alias("text_ja"),
        F.when(F.col("doc_id") % 9 == 0, "error").otherwise("ok").alias("status"),
    )
    return route_error_rows(rows)


@query(
    "token_count",
    f"WITH {EDGE} SELECT doc_id, CASE WHEN text IS NULL THEN NULL WHEN {SPECIAL} THEN -1 ELSE strlen(text) END AS n_tokens FROM edge",
)
def token_count_query(spark, sf_dir):
    """Texts with special tokens are refused; single bytes are the only tokens."""
    return token_counts(edge_documents(spark, sf_dir), ("doc_id",), byte_tokenizer())


@query(
    "token_count_merged",
    "SELECT doc_id, strlen(text) - (strlen(text) - strlen(replace(text, 'th', ''))) // 2 AS n_tokens FROM documents",
)
def token_count_merged_query(spark, sf_dir):
    return token_counts(documents(spark, sf_dir), ("doc_id",), byte_tokenizer([b"th"]))


@query("estimate_tokens", f"WITH {EDGE} SELECT doc_id, CAST({TOKENS} AS BIGINT) AS n_tokens FROM edge")
def estimate_tokens_query(spark, sf_dir):
    return edge_documents(spark, sf_dir).select("doc_id", estimate_tokens(F.col("text")).alias("n_tokens"))


@query(
    "estimate_request_tokens",
    f"WITH {EDGE} SELECT doc_id, CAST({REQUEST_FIXED} + {TOKENS} AS BIGINT) AS request_tokens FROM edge",
)
def estimate_request_tokens_query(spark, sf_dir):
    size = estimate_request_tokens(F.col("text"))
    return edge_documents(spark, sf_dir).select("doc_id", size.alias("request_tokens"))


@query(
    "build_messages",
    """SELECT doc_id, 6 AS turns, 'system,user,assistant,user,assistant,user' AS roles,
              text AS last_content, CAST(703 - 5 + strlen(text) AS BIGINT) AS prompt_bytes FROM documents""",
)
def build_messages_query(spark, sf_dir):
    """Prompt bytes are those of the joined prompt without its five line breaks."""
    turns = F.col("messages")
    sizes = F.transform(turns, lambda turn: F.octet_length(turn["content"]).cast("bigint"))
    built = documents(spark, sf_dir).select("doc_id", build_messages(F.col("text")).alias("messages"))
    return built.select(
        "doc_id",
        F.size(turns).alias("turns"),
        F.array_join(turns["role"], ",").alias("roles"),
        F.element_at(turns, -1)["content"].alias("last_content"),
        F.aggregate(sizes, F.lit(0).cast("bigint"), lambda total, size: total + size).alias("prompt_bytes"),
    )


def error_messages(spark, sf_dir):
    """An error message per event, in every spelling."""
    number = F.col("event_id")
    whole = F.floor("value").cast("bigint").cast("string")
    message = (
        F.when(number % 6 == 0, F.concat(F.lit("Rate limit reached. Please try again in "), whole, F.lit("ms.")))
        .when(number % 6 == 1, F.concat(F.lit("Error code: 429. Try Again In "), whole, F.lit(".5s")))
        .when(number % 6 == 2, F.lit("RATE LIMIT: try again in 1m2s"))
        .when(number % 6 == 3, F.concat(F.lit("try again in 0s or try again in "), whole, F.lit("MS")))
        .when(number % 6 == 4, F.lit("connection reset; try again in 1.2.3s"))
        .otherwise(F.concat(F.lit("bad request for "), "event_type"))
    )
    return table(spark, sf_dir, "events").select("event_id", message.alias("message"))


MESSAGES = """msg AS (SELECT event_id, CASE event_id % 6
  WHEN 0 THEN 'Rate limit reached. Please try again in ' || CAST(floor(value) AS BIGINT) || 'ms.'
  WHEN 1 THEN 'Error code: 429. Try Again In ' || CAST(floor(value) AS BIGINT) || '.5s'
  WHEN 2 THEN 'RATE LIMIT: try again in 1m2s'
  WHEN 3 THEN 'try again in 0s or try again in ' || CAST(floor(value) AS BIGINT) || 'MS'
  WHEN 4 THEN 'connection reset; try again in 1.2.3s'
  ELSE 'bad request for ' || event_type END AS message FROM events),
waits AS (SELECT event_id, message, coalesce(
  TRY_CAST(nullif(regexp_extract(message, '(?i)try again in ([0-9]+)ms', 1), '') AS DOUBLE) / 1000.0,
  TRY_CAST(nullif(regexp_extract(message, '(?i)try again in ([0-9.]+)s', 1), '') AS DOUBLE)) AS wait FROM msg)"""


@query(
    "parse_retry_after",
    f"""WITH {MESSAGES} SELECT event_id, round(wait, 6) AS retry_after,
        round(CASE WHEN wait > 0 THEN wait ELSE 1.0 END, 6) AS wait_seconds FROM waits""",
)
def parse_retry_after_query(spark, sf_dir):
    message = F.col("message")
    return error_messages(spark, sf_dir).select(
        "event_id",
        F.round(parse_retry_after(message), 6).alias("retry_after"),
        F.round(rate_limit_wait(message), 6).alias("wait_seconds"),
    )


@query(
    "is_rate_limit_error",
    f"WITH {MESSAGES} SELECT event_id, lower(message) LIKE '%rate limit%' OR message LIKE '%429%' AS limited FROM msg",
)
def is_rate_limit_error_query(spark, sf_dir):
    return error_messages(spark, sf_dir).select("event_id", is_rate_limit_error(F.col("message")).alias("limited"))


@query(
    "retry_delay",
    """SELECT event_id, user_id % 4 AS attempt,
              CASE WHEN user_id % 4 < 2 THEN CAST(0.5 * (user_id % 4 + 1) AS DOUBLE) END AS delay FROM events""",
)
def retry_delay_query(spark, sf_dir):
    attempt = F.col("user_id") % 4
    return table(spark, sf_dir, "events").select(
        "event_id", attempt.alias("attempt"), retry_delay(attempt).alias("delay")
    )


@query("bucket_of", f"SELECT doc_id, ({TOKENS}) // 200 AS bucket FROM documents")
def bucket_of_query(spark, sf_dir):
    bucket = bucket_of(estimate_tokens(F.col("text")), 200)
    return documents(spark, sf_dir).select("doc_id", bucket.alias("bucket"))


@query("shard_name", "SELECT doc_id, printf('%s-%05d.parquet', source, doc_id) AS shard FROM documents")
def shard_name_query(spark, sf_dir):
    return documents(spark, sf_dir).select("doc_id", shard_name(F.col("source"), F.col("doc_id")).alias("shard"))


LIMITS = """given AS (SELECT event_id, CAST(user_id % 7 AS VARCHAR) AS tier,
   CASE event_id % 4 WHEN 0 THEN NULL WHEN 1 THEN 0 WHEN 2 THEN user_id - 20 ELSE NULL END AS argument,
   CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN ' ' || (user_id * 10) || ' ' ELSE 'many' END AS override FROM events),
tier_table(name, rpm, tpm) AS (VALUES ('1', 500, 200000), ('2', 5000, 2000000), ('3', 5000, 4000000),
   ('4', 10000, 10000000), ('5', 30000, 180000000))"""


@query(
    "resolve_limits",
    f"""WITH {LIMITS}, joined AS (
          SELECT g.*, coalesce(t.rpm, 500) AS tier_rpm, coalesce(t.tpm, 200000) AS tier_tpm,
                 CASE WHEN argument IS NOT NULL THEN argument ELSE TRY_CAST(nullif(trim(override), '') AS BIGINT) END AS picked
          FROM given g LEFT JOIN tier_table t ON g.tier = t.name)
        SELECT event_id, CAST(greatest(1, coalesce(nullif(picked, 0), tier_rpm)) AS BIGINT) AS rpm,
               CAST(greatest(1, coalesce(nullif(picked, 0), tier_tpm)) AS BIGINT) AS tpm FROM joined""",
)
def resolve_limits_query(spark, sf_dir):
    number, user = F.col("event_id"), F.col("user_id")
    tier = (user % 7).cast("string")
    argument = F.when(number % 4 == 1, F.lit(0)).when(number % 4 == 2, user - 20)
    override = F.when(number % 3 == 0, "").when(
        number % 3 == 1, F.concat(F.lit(" "), (user * 10).cast("string"), F.lit(" "))
    ).otherwise("many")
    columns = [resolve_limit_column(argument, override, tier, which).alias(which) for which in ("rpm", "tpm")]
    return table(spark, sf_dir, "events").select("event_id", *columns)


@query(
    "pct_of_total",
    """SELECT source, count(*) AS cnt, sum(count(*)) OVER ()::BIGINT AS total,
              round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 6) AS pct FROM documents GROUP BY source""",
)
def pct_of_total_query(spark, sf_dir):
    """Share of each source; only the one total reaches the driver."""
    counts = documents(spark, sf_dir).groupBy("source").agg(F.count("*").alias("cnt"))
    total = F.lit(counts.agg(F.sum("cnt")).first()[0]).cast("bigint")
    return counts.select(
        "source", "cnt", total.alias("total"), F.round(pct_of_total(F.col("cnt"), total), 6).alias("pct")
    )
