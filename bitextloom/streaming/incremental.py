"""Incremental runs over a growing folder, restartable from a checkpoint.

Each run processes the files it has not seen and stops (`availableNow`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from bitextloom.defaults import FILTER_MAX_TOKENS, FILTERED_COLUMN
from bitextloom.functions.tokens import Tokenizer
from bitextloom.operators.backends import Backend
from bitextloom.operators.enrich import enrich_text
from bitextloom.operators.filters import fate, fate_counters
from bitextloom.sources.paths import path_exists
from bitextloom.sources.state import StateLog
from bitextloom.streaming.watch import RunWatch, with_files

FILES_PER_BATCH = 1000
COUNTERS = ("processed", "skipped", "skipped_special", "kept", "over_limit")
BATCH_COUNTERS = "batch_id bigint, " + ", ".join(f"{name} bigint" for name in COUNTERS)


def read_new_files(
    spark: SparkSession,
    folder: str,
    schema: str,
    pattern: str = "*.parquet",
    files_per_batch: int = FILES_PER_BATCH,
) -> DataFrame:
    """Stream of the parquet files of a folder."""
    return (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", pattern)
        .option("maxFilesPerTrigger", files_per_batch)
        .parquet(folder)
    )


def incremental_enrich(
    stream: DataFrame,
    translate: Backend | Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    key: str = "row_id",
    text: str = "text",
    state: StateLog | None = None,
    **options,
) -> StreamingQuery:
    """Translate new rows into `out/batch_id=<n>/`; returns the started query.

    `translate` is a backend, or what `plans.translator` returns for a named one.
    A batch replaces its own folder, so a replay after a failure adds no rows.
    The model is called once per row of a batch: the batch is written first,
    and progress is counted from what was written.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        folder = f"{out}/batch_id={batch_id}"
        if isinstance(translate, Backend):
            enriched = enrich_text(batch, translate, key, text, **options)
        else:
            enriched = translate(batch.select(key, F.col(text).alias("text")))
        enriched.write.mode("overwrite").option("compression", "zstd").parquet(folder)
        if state is not None:
            rows = spark.read.schema(enriched.schema).parquet(folder).count()
            last = state.latest()
            if last is None or last["shard_id"] < batch_id:
                done = rows + (last["written"] if last else 0)
                state.append(processed=done, written=done, shard_id=batch_id)

    return (
        stream.writeStream.foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def incremental_filter(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    max_tokens: int = FILTER_MAX_TOKENS,
    text: str = "text",
    keep: tuple[str, ...] = (),
    tokenizer: Tokenizer | None = None,
    progress: str | None = None,
    watch: str | None = None,
) -> StreamingQuery:
    """Filter new rows into `out/batch_id=<n>/`; returns the started query.

    A batch replaces its own folder, so a replay after a failure adds no rows.
    Its counters are observed while it is written and then stored in the table
    `progress`, one row for each batch, for `live_progress`. The table `watch` gets the events of the run, for
    `run_state`; the stream must then be one of files.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        seen = Observation(f"filter-{batch_id}")
        marked = batch.withColumn("_fate", fate(F.col(text), max_tokens, tokenizer))
        counted = marked.observe(seen, *fate_counters(F.col("_fate")))
        kept = counted.where(F.col("_fate") == "kept").select(*keep, F.col(text).alias(FILTERED_COLUMN))
        kept.write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/batch_id={batch_id}")
        if progress is not None:
            row = (batch_id, *(seen.get[name] for name in COUNTERS))
            batch.sparkSession.createDataFrame([row], BATCH_COUNTERS).coalesce(1).write.mode("append").parquet(progress)

    each = save
    if watch is not None:
        listener = RunWatch(stream.sparkSession, watch)
        stream, each = with_files(stream), listener.watched(save, stream.columns)
        stream.sparkSession.streams.addListener(listener)
    return (
        stream.writeStream.foreachBatch(each)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def live_progress(spark: SparkSession, progress: str) -> DataFrame:
    """Counters of every batch a filter has finished, over all its runs; a batch that was replayed counts once."""
    if not path_exists(spark, progress):
        return spark.createDataFrame([], BATCH_COUNTERS)
    return spark.read.schema(BATCH_COUNTERS).parquet(progress).dropDuplicates(["batch_id"])
