"""The corpus pipeline: toxicity, exact copies, near copies, mixing, encoding.

Every stage takes documents as the one before left them and decides by its own input alone. Stages 1 to 4 return the
columns they were given, whatever they are; the last returns what the encoder writes for each row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.llm.catalog import PIECE_MODEL, qualities, table
from bitextloom.llm.exact_dedup import drop_exact_copies
from bitextloom.llm.minhash_dedup import drop_near_copies
from bitextloom.llm.piece_codec import decode_ids, encode_texts
from bitextloom.llm.source_mix import take_mix
from bitextloom.llm.tables import stored
from bitextloom.llm.toxicity import drop_toxic
from bitextloom.session import scoped_conf

# A trained model and a learned vocabulary have no SQL; the tests compare every stage with a plain version.
ORACLE_SQL = None

# The workers of the stages before the encoder's still hold memory when it starts: its own take smaller word tables and
# batches, and encode and decode one after the other, not both in one task.
WORD_BYTES = 16 << 20
BATCH_ROWS = 256

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a model of the labels scores 0.3 or more go; all others stay."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest doc_id stays."""
    return drop_exact_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 over five-word shingles the smallest doc_id stays."""
    return drop_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources, weighed by the quality of its label, takes it, none more than three times."""
    return take_mix(docs, qualities(spark, sf_dir))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each row, as op7 returns them."""
    with scoped_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch=str(BATCH_ROWS)):
        ids = stored(encode_texts(docs, PIECE_MODEL, WORD_BYTES), "encoded-ids")
        encoded = decode_ids(ids, PIECE_MODEL).select(
            "doc_id",
            (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
            F.sha2("ids", 256).alias("ids_sha256"),
            F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
        )
        return stored(encoded, "encoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("exact dedup", exact),
    ("near dedup", near),
    ("mix", mix),
    ("encode", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return docs
