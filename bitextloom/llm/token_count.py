"""Token counts by heap-and-linked-list byte-pair merging, without identifiers."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bitextloom.llm.pieces import WordTable, pieces, row_parts
from bitextloom.llm.tables import text_or_empty

TOKEN_LIMIT = 4096


def count_tokens(docs: DataFrame, model: str, limit: int = TOKEN_LIMIT) -> DataFrame:
    """One row per row of `docs`: doc_id, n_bytes, n_tokens, over_limit.

    Counts are those of the sentencepiece BPE model at `model` (a path every executor can read), without begin
    and end. A null or empty text has 0 bytes and 0 tokens. One narrow pass, no shuffle: each worker keeps the
    counts of distinct words in a table of 128 MB and merges any other word anew.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = pieces(model)
        table = WordTable(vocabulary.count)
        for batch in row_parts(batches):
            counts = [sum(map(table.__getitem__, vocabulary.split(text))) for text in batch.column("text").to_pylist()]
            columns = [batch.column("doc_id"), batch.column("n_bytes"), pa.array(counts, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    texts = docs.select("doc_id", text_or_empty().alias("text"))
    texts = texts.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "text")
    counted = texts.mapInArrow(count, f"doc_id {kind}, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
