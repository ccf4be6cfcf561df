"""What a streaming run has done, has in flight and has still to do, in a table that any session can read while it runs."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from bitextloom.sources.counts import rows_per_file
from bitextloom.sources.paths import list_files, path_exists
from bitextloom.sources.positions import file_path

EVENTS = "at double, query string, event string, batch_id bigint, files bigint, rows bigint"
BEGUN, FINISHED, STARTED, STOPPED = "begun", "finished", "started", "stopped"


class RunWatch(StreamingQueryListener):
    """Listens to one query and keeps its events in the table at `path`.

    The query's own events say when it starts, which batches are committed with how many rows, and when it ends;
    `watched` wraps the function of its batches, which says what files and rows a batch begins with. Events are appended, one small
    file each, and the newest of a batch counts, so a replayed batch counts once.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path, self.query = spark, path, None

    def watched(self, save: Callable[[DataFrame, int], None], names: list[str]) -> Callable[[DataFrame, int], None]:
        """`save` for a stream that `with_files` prepared; it gets the columns `names`."""

        def begin(batch: DataFrame, batch_id: int) -> None:
            # Of parquet files no column is read for this.
            held = batch.agg(F.count_distinct("_watched_file").alias("files"), F.count(F.lit(1)).alias("rows")).first()
            self.add(BEGUN, batch_id, held["files"], held["rows"])
            save(batch.select(*(f"`{name}`" for name in names)), batch_id)

        return begin

    def add(self, event: str, batch_id: int | None = None, files: int | None = None, rows: int | None = None) -> None:
        row = (time.time(), self.query, event, batch_id, files, rows)
        # The query and its listener write at the same time: a folder each, as one commit clears what another has begun.
        self.spark.createDataFrame([row], EVENTS).coalesce(1).write.parquet(f"{self.path}/{uuid.uuid4().hex}")

    def follow(self, query) -> None:
        """From now on the events of `query` are kept."""
        self.query = str(query.id)

    def onQueryStarted(self, event) -> None:
        if self.query is None:
            self.query = str(event.id)
            self.add(STARTED)

    def onQueryProgress(self, event) -> None:
        if str(event.progress.id) == self.query and event.progress.numInputRows:
            self.add(FINISHED, event.progress.batchId, None, event.progress.numInputRows)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        if str(event.id) == self.query:
            self.add(STOPPED)
            self.spark.streams.removeListener(self)


def with_files(stream: DataFrame) -> DataFrame:
    """A file stream whose rows know their file."""
    return stream.select("*", file_path().alias("_watched_file"))


def run_events(spark: SparkSession, path: str) -> DataFrame:
    """All events of the table."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], EVENTS)
    return spark.read.schema(EVENTS).option("recursiveFileLookup", True).parquet(path)


def run_state(spark: SparkSession, path: str, folder: str, pattern: str = "*.parquet") -> DataFrame:
    """One row: files and rows that are done, in flight and pending of a watched run over a folder of parquet files, and
    whether the run is alive.

    A batch that has begun is in flight until it is committed; when its run has stopped it is pending again. Files that came after the
    run began are pending too. Counts come from footers.
    """
    events = run_events(spark, path)
    last = events.where(F.col("event").isin(STARTED, STOPPED)).agg(F.max_by("event", "at").alias("last"))
    batches = events.where("batch_id IS NOT NULL").groupBy("batch_id").agg(
        F.max_by("files", F.when(F.col("event") == BEGUN, F.col("at"))).alias("files"),
        F.max_by("rows", F.when(F.col("event") == BEGUN, F.col("at"))).alias("rows"),
        F.max(F.col("event") == FINISHED).alias("finished"),
    )
    every = rows_per_file(spark, folder).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("all_rows"))
    listed = list_files(spark, folder, pattern).agg(F.count(F.lit(1)).alias("all_files"))
    alive = F.coalesce(F.col("last") == STARTED, F.lit(False))

    def total(name: str, finished: bool):
        return F.coalesce(F.sum(F.when(F.col("finished") == finished, F.col(name))), F.lit(0))

    sums = batches.agg(
        *(total(name, True).alias(f"{name}_done") for name in ("files", "rows")),
        *(total(name, False).alias(f"{name}_begun") for name in ("files", "rows")),
    )
    # One row each.
    whole = sums.join(F.broadcast(last), how="cross").join(F.broadcast(every), how="cross").join(F.broadcast(listed), how="cross")
    columns = [alive.alias("alive")]
    for name in ("files", "rows"):
        flying = F.when(alive, F.col(f"{name}_begun")).otherwise(0)
        columns += [F.col(f"{name}_done"), flying.alias(f"{name}_in_flight"), (F.col(f"all_{name}") - F.col(f"{name}_done") - flying).alias(f"{name}_pending")]
    return whole.select(*columns)


def wait_for_stop(spark: SparkSession, path: str, seconds: float = 60) -> bool:
    """Whether the end of a watched run came within `seconds`: events follow the query a little later."""
    until = time.time() + seconds
    while time.time() < until:
        last = run_events(spark, path).agg(F.max_by("event", "at")).first()[0]
        if last == STOPPED:
            return True
        time.sleep(0.2)
    return False
