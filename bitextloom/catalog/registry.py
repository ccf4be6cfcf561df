"""Registry of the checked queries: name, Spark query, and the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query; `sql` runs on the same tables in another engine."""

    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def edge_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; some texts become null, empty, or gain a special token."""
    number = F.col("doc_id")
    text = (
        F.when(number % 17 == 0, F.lit(None).cast("string"))
        .when(number % 13 == 0, "")
        .when(number % 11 == 0, F.concat("text", F.lit(" <|endoftext|>")))
        .when(number % 7 == 0, F.concat(F.lit("<|reserved_201087|>"), "text"))
        .when(number % 5 == 0, F.concat("text", F.lit(" <|reserved_201088|> <|end |>")))
        .otherwise(F.col("text"))
    )
    return documents(spark, sf_dir).select("doc_id", "lang", "source", text.alias("text"))


EDGE = """edge AS (
  SELECT doc_id, lang, source,
         CASE WHEN doc_id % 17 = 0 THEN NULL
              WHEN doc_id % 13 = 0 THEN ''
              WHEN doc_id % 11 = 0 THEN text || ' <|endoftext|>'
              WHEN doc_id % 7 = 0 THEN '<|reserved_201087|>' || text
              WHEN doc_id % 5 = 0 THEN text || ' <|reserved_201088|> <|end |>'
              ELSE text END AS text
  FROM documents)"""

SPECIAL = r"""coalesce(regexp_matches(text, '<\|(startoftext|endoftext|endofprompt|return|constrain|channel|start|end|message|call|reserved_(20000[014]|200009|20001[013-9]|2000[2-9][0-9]|200[1-9][0-9]{2}|2010[0-7][0-9]|20108[0-7]))\|>'), false)"""

TOKENS = "CASE WHEN coalesce(text, '') = '' THEN 0 ELSE greatest(1, strlen(text) // 3) END"

CLASSED = f"""{EDGE}, classed AS (
  SELECT *, CASE WHEN text IS NULL THEN 'missing' WHEN text = '' THEN 'empty'
                 WHEN {SPECIAL} THEN 'special' ELSE 'ok' END AS kind FROM edge),
counted AS (
  SELECT *, CAST(CASE WHEN kind = 'ok' THEN {TOKENS} ELSE 0 END AS BIGINT) AS n FROM classed)"""

# Bytes of the prompt around an empty text, and the completion allowance.
REQUEST_FIXED = 703 // 3 + 4096
