"""Row positions in sorted-file order, without numbering rows in one task.

A position is the number of rows in earlier files (a running sum over files,
not rows) plus the row's index in its own file, which parquet supplies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.prefix import running_total
from bitextloom.session import scratch_path

# Per-file tables up to this many rows are broadcast: at some 200 bytes a row, under 100 MB.
BROADCAST_FILES = 500_000


def file_path() -> Column:
    """Path of a row's file as it is spelled, not as a URI: sorting it sorts the names.

    A URI escapes spaces and non-ASCII letters, but not the plus sign.
    """
    return F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))


def row_index() -> Column:
    return F.col("_metadata.row_index")


def file_count(df: DataFrame) -> int:
    """Files of a scan; only the length of the JVM's list crosses to Python."""
    return len(df._jdf.inputFiles())


def file_offsets(df: DataFrame) -> DataFrame:
    """Per file of a parquet scan: rows, and `start`, the rows in files before it."""
    per_file = df.select(file_path().alias("file_path")).groupBy("file_path").agg(F.count("*").alias("rows"))
    return running_total(per_file, ["file_path"], "rows", "start", file_count(df))


def global_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Add the 0-based position of each row of a parquet scan.

    The offsets are broadcast only while the number of files is small; beyond
    that Spark joins by file and splits a file that dominates.
    """
    offsets = file_offsets(df).select(F.col("file_path").alias("_file"), "start")
    if file_count(df) <= BROADCAST_FILES:
        offsets = F.broadcast(offsets)
    rows = df.select("*", file_path().alias("_file"), row_index().alias("_index"))
    numbered = rows.join(offsets, "_file", "left")
    return numbered.withColumn(name, F.col("start") + F.col("_index")).drop("_file", "_index", "start")


def rows_between(
    df: DataFrame, first: int, last: int, offsets: DataFrame, name: str = "ordinal"
) -> DataFrame:
    """Rows of a parquet scan at positions `first` (included) to `last` (excluded), with position.

    `offsets` is a stored `file_offsets` table, so that repeated slices do not
    count files again. Only files of the slice are opened.
    """
    ends = F.col("start") + F.col("rows")
    files = offsets.where((F.col("start") < last) & (ends > first) & (F.col("rows") > 0))
    low, high, count = files.agg(F.min("file_path"), F.max("file_path"), F.count("*")).first()
    starts = files.select(F.col("file_path").alias("_file"), "start")
    if count <= BROADCAST_FILES:
        starts = F.broadcast(starts)
    opened = df.where(file_path().between(low or "", high or ""))
    rows = opened.select("*", file_path().alias("_file"), row_index().alias("_index"))
    numbered = rows.join(starts, "_file").withColumn(name, F.col("start") + F.col("_index"))
    return numbered.where(F.col(name).between(first, last - 1)).drop("_file", "_index", "start")


def _file_holding(df: DataFrame, position: int):
    """(path, start) of the file that holds a position; None beyond the last row."""
    offsets = file_offsets(df).where(
        (F.col("start") <= position) & (F.col("start") + F.col("rows") > position)
    )
    return offsets.first()


def scan_from_offset(df: DataFrame, skip: int) -> DataFrame:
    """Rows of a parquet scan after the first `skip`, in sorted-file order.

    Only one (path, start) pair reaches the driver. Files before it are dropped
    while listing, and no row moves.
    """
    if skip <= 0:
        return df
    cut = _file_holding(df, skip)
    if cut is None:
        return df.where(F.lit(False))
    path, inside = cut["file_path"], skip - cut["start"]
    return df.where(file_path() >= path).where((file_path() > path) | (row_index() >= inside))


def take_first_rows(df: DataFrame, cap: int) -> DataFrame:
    """The first `cap` rows of a parquet scan in sorted-file order; negative means all.

    Later files are not opened, and no row moves.
    """
    if cap < 0:
        return df
    if cap == 0:
        return df.where(F.lit(False))
    cut = _file_holding(df, cap - 1)
    if cut is None:
        return df
    path, inside = cut["file_path"], cap - cut["start"]
    return df.where(file_path() <= path).where((file_path() < path) | (row_index() < inside))


def stage_jsonl(spark: SparkSession, paths: str | list[str], staging: str | None = None) -> DataFrame:
    """JSON-lines as parquet with stable positions: columns `ordinal, value`.

    Blank lines are no rows. A line has no index of its own, but Spark reads a split front to back and
    numbers its rows upward. One job stores each line with its file, its split
    and that number; the position then follows from stored columns only, so a
    lost executor cannot change it.
    """
    out = staging or scratch_path(spark, "lines")
    lines = spark.read.text(paths).where(F.trim("value") != "").select(
        "value",
        file_path().alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
    )
    lines.write.option("compression", "zstd").parquet(out)
    stored = spark.read.parquet(out)
    splits = stored.groupBy("file", "block").agg(
        F.count("*").alias("rows"), F.min("seq").alias("first_seq")
    )
    split_count = splits.count()
    splits = running_total(splits, ["file", "block"], "rows", "start", split_count).drop("rows")
    # One row per split: checked like the file table above.
    if split_count <= BROADCAST_FILES:
        splits = F.broadcast(splits)
    ordinal = F.col("start") + F.col("seq") - F.col("first_seq")
    return stored.join(splits, ["file", "block"]).select(ordinal.alias("ordinal"), "value")


def first_jsonl_rows(spark: SparkSession, paths: list[str], cap: int) -> DataFrame:
    """The first `cap` lines of sorted JSON-lines files, as `ordinal, value`.

    Only as many leading files are read as hold that many lines; their number
    is found by doubling.
    """
    if cap <= 0:
        return spark.createDataFrame([], "ordinal bigint, value string")
    files = 1
    while files < len(paths) and spark.read.text(paths[:files]).where(F.trim("value") != "").count() < cap:
        files *= 2
    return stage_jsonl(spark, paths[:files]).where(F.col("ordinal") < cap)
