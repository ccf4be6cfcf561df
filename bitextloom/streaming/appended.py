"""JSON-lines files that grow between runs: each run takes the lines that were appended since the last one."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bitextloom.session import scratch_path
from bitextloom.sources.paths import path_exists
from bitextloom.sources.positions import BROADCAST_FILES, file_path

TAKEN = "run bigint, file string, bytes bigint, lines bigint, taken_at bigint"


def numbered_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, line (0, 1, ... within the file) and value of all lines, stored.

    Spark reads a split front to back and numbers its rows upward; with the rows of the splits before it in
    the same file, that gives the line. Big files are read by many tasks, and only one row a split is summed up.
    """
    out = scratch_path(spark, "numbered-lines")
    lines = spark.read.text(files).select(
        "value", file_path().alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("seq")
    )
    lines.write.option("compression", "zstd").parquet(out)
    stored = spark.read.parquet(out)
    splits = stored.groupBy("file", "block").agg(F.count(F.lit(1)).alias("own"), F.min("seq").alias("low"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", (F.coalesce(F.sum("own").over(before), F.lit(0)) - F.col("low")).alias("shift"))
    if splits.count() <= BROADCAST_FILES:
        splits = F.broadcast(splits)
    return stored.join(splits, ["file", "block"]).select("file", (F.col("seq") + F.col("shift")).alias("line"), "value")


class AppendedLines:
    """The lines of a folder's files that no committed run has taken.

    The table `state` has, for each run and file it read, how many lines and bytes the file then had. A file is read again only
    when its size differs, and of it the lines beyond the known number are new; one that has become shorter is another
    file, all of whose lines are new. Lines are appended whole: an unterminated last line counts as one.
    """

    def __init__(self, spark: SparkSession, folder: str, state: str, pattern: str = "*.json*") -> None:
        self.spark, self.folder, self.state, self.pattern = spark, folder, state, pattern
        self.run = self.taken().agg(F.coalesce(F.max("run") + 1, F.lit(0))).first()[0]
        self.read: DataFrame | None = None

    def taken(self) -> DataFrame:
        if not path_exists(self.spark, self.state):
            return self.spark.createDataFrame([], TAKEN)
        return self.spark.read.schema(TAKEN).parquet(self.state)

    def pending(self) -> DataFrame:
        """file, line and value of the new lines, blank ones left out."""
        newest = self.taken().groupBy("file").agg(F.max_by(F.struct("bytes", "lines"), "run").alias("known"))
        listing = self.spark.read.format("binaryFile").option("pathGlobFilter", self.pattern).load(self.folder)
        listing = listing.select(F.col("path").alias("file"), F.col("length").alias("size")).where("size > 0")
        changed = listing.join(newest, "file", "left").where("known IS NULL OR known.bytes <> size")
        known = F.when(F.col("known.bytes") <= F.col("size"), F.col("known.lines"))
        files = changed.select("file", "size", F.coalesce(known, F.lit(0)).alias("known_lines")).collect()
        if not files:
            self.read = None
            return self.spark.createDataFrame([], "file string, line bigint, value string")
        lines = numbered_lines(self.spark, [row["file"] for row in files])
        opened = self.spark.createDataFrame(files, "file string, size bigint, known_lines bigint")
        if len(files) <= BROADCAST_FILES:
            opened = F.broadcast(opened)
        joined = lines.join(opened, "file")
        self.read = joined.groupBy("file").agg(F.first("size").alias("bytes"), (F.max("line") + 1).alias("lines"))
        return joined.where("line >= known_lines AND trim(value) <> ''").select("file", "line", "value")

    def commit(self) -> None:
        """What `pending` gave is taken."""
        if self.read is not None:
            now = F.lit(int(time.time())).cast("bigint")
            rows = self.read.select(F.lit(self.run).cast("bigint").alias("run"), "file", "bytes", "lines", now.alias("taken_at"))
            rows.coalesce(1).write.mode("append").parquet(self.state)


def process_appended(
    spark: SparkSession, folder: str, out: str, state: str, transform: Callable[[DataFrame], DataFrame], pattern: str = "*.json*"
) -> int:
    """One run: `transform` (of file, line, value) of the new lines to `out/run=<n>/`, then committed; returns the run's number.

    A run that broke off before it was committed is repeated under its number and replaces what it had written.
    """
    lines = AppendedLines(spark, folder, state, pattern)
    transform(lines.pending()).write.mode("overwrite").option("compression", "zstd").parquet(f"{out}/run={lines.run}")
    lines.commit()
    return lines.run
