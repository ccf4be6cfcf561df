"""Parquet sinks: by rows, by size, in order, and resharded for publication."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.defaults import (
    FILTER_MAX_FILE_MB,
    PUBLISH_MAX_SHARD,
    PUBLISH_SPLIT,
    ROWS_PER_SHARD,
    TRANSLATE_PREFIX,
)
from bitextloom.functions.numbers import int_div
from bitextloom.functions.shards import shard_name, shard_number
from bitextloom.operators.resume import next_shard_number
from bitextloom.prefix import running_total
from bitextloom.session import scoped_conf, scratch_path
from bitextloom.sinks.sizes import WEIGHT, row_weight, split_files_over, write_shards
from bitextloom.sources.paths import list_files, remove, rename, scan_targets
from bitextloom.sources.positions import file_count, file_path

MB = 1024 * 1024
# Part of the allowed shard size that is planned for; rows of one file vary in size.
FILL = 0.8
# Rows of one task of an ordered write, whatever the session's shuffle partitions.
MIN_TASK_ROWS = 1_000
MAX_TASK_ROWS = 1_000_000

# fixed values: decimal and binary size units
UNITS = {"KB": 10**3, "MB": 10**6, "GB": 10**9, "TB": 10**12,
         "KIB": 2**10, "MIB": 2**20, "GIB": 2**30, "TIB": 2**40}


def parse_size(size: str | int) -> int:
    """Bytes of `1GB`, `500MB`, `2GiB` or a plain number."""
    if isinstance(size, int):
        return size
    found = re.fullmatch(r"\s*(\d+)\s*([A-Za-z]*)\s*", size)
    unit = found.group(2).upper() if found else ""
    if not found or (unit and unit not in UNITS):
        raise ValueError(f"cannot read size: {size}")
    return int(found.group(1)) * UNITS.get(unit, 1)


def _parquet(df: DataFrame, path: str, mode: str, **options) -> None:
    df.write.mode(mode).option("compression", "zstd").options(**options).parquet(path)


def write_by_rows(
    df: DataFrame,
    path: str,
    rows_per_file: int = ROWS_PER_SHARD,
    ordinal: str | None = None,
    total_rows: int | None = None,
    mode: str = "append",
) -> None:
    """At most `rows_per_file` rows per file.

    Without an ordinal each task cuts its own rows and nothing is shuffled.
    With one (and the total), files hold exactly `rows_per_file` consecutive
    rows and only the last is short.
    """
    rows_per_file = max(1, rows_per_file)
    if ordinal is not None:
        if total_rows is None:
            raise ValueError("an ordered write needs the number of rows: counting would compute the rows twice")
        tasks = _write_tasks(df.sparkSession, total_rows)
        shards = max(1, -(-total_rows // rows_per_file))
        rows_per_task = -(-shards // tasks) * rows_per_file
        df = _contiguous(df, ordinal, rows_per_task, min(tasks, shards))
    _parquet(df, path, mode, maxRecordsPerFile=rows_per_file)


def write_ordered(
    df: DataFrame,
    path: str,
    ordinal: str = "ordinal",
    *,
    total_rows: int,
    files: int | None = None,
    mode: str = "append",
    keep_ordinal: bool = True,
) -> None:
    """Files whose sorted names follow the ordinals 0..n-1; the caller knows the number of rows.

    The partition is computed from the ordinal, so there is no sampling pass
    over the rows as a range partitioning would need.
    """
    files = files or _write_tasks(df.sparkSession, total_rows)
    rows_per_task = max(1, -(-total_rows // files))
    placed = _contiguous(df, ordinal, rows_per_task, files)
    _parquet(placed if keep_ordinal else placed.drop(ordinal), path, mode)


def _write_tasks(spark: SparkSession, rows: int) -> int:
    """Tasks of an ordered write: the session's shuffle partitions, within rows per task."""
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, -(-rows // MAX_TASK_ROWS), min(wanted, rows // MIN_TASK_ROWS))


def _contiguous(df: DataFrame, ordinal: str, rows_per_task: int, tasks: int) -> DataFrame:
    task = int_div(F.col(ordinal), rows_per_task).cast("int")
    return df.repartitionById(tasks, task).sortWithinPartitions(ordinal)


def write_by_size(
    df: DataFrame,
    path: str,
    max_mb: float = FILTER_MAX_FILE_MB,
    stored_ratio: float = 0.5,
    shuffle: bool = True,
    mode: str = "append",
    fill: float = FILL,
) -> None:
    """Files of at most `max_mb` megabytes, but for files of a single row.

    By default the rows are stored once in the scratch folder, which gives the size model: what the codec makes
    of each stretch of them. Their places on the line of stored bytes are cut into shards of `fill` times the limit, in the order of
    the frame's partitions. `shuffle=False` sizes the input splits instead and moves nothing, with `stored_ratio` as stored
    bytes per input byte; use it for filters that keep most rows. Either way the written files are
    measured, and those over the limit, and no others, are split. With `mode="append"` that holds for all files of the folder.
    """
    spark, limit = df.sparkSession, max(1, int(max_mb * MB))
    if shuffle:
        staged = scratch_path(spark, "sized")
        weighed = df.withColumn(WEIGHT, row_weight(df))
        _parquet(weighed, staged, "errorifexists")
        rows = spark.read.schema(weighed.schema).parquet(staged)
        write_shards(rows, df.columns, F.col(WEIGHT), max(1, int(limit * fill)), path, mode, _parquet)
        remove(spark, staged)
    else:
        with scoped_conf(spark, spark__sql__files__maxPartitionBytes=str(max(1, int(limit * fill / stored_ratio)))):
            _parquet(df, path, mode)
    split_files_over(spark, path, limit, fill, _parquet)


def shard_manifest(
    spark: SparkSession, path: str, prefix: str = TRANSLATE_PREFIX, start_id: int = 0
) -> DataFrame:
    """One row per stored file with rows: shard_id, shard, path, rows, bytes.

    Spark names its files; the manifest numbers them in path order, from
    `start_id` on.
    """
    stored = spark.read.parquet(path)
    files = stored.groupBy(file_path().alias("path"), F.col("_metadata.file_size").alias("bytes")).agg(
        F.count(F.lit(1)).alias("rows"), F.lit(1).alias("one")
    )
    numbered = running_total(files, ["path"], "one", "place", file_count(stored))
    numbered = numbered.withColumn("shard_id", (F.col("place") + start_id).cast("bigint"))
    return numbered.select(
        "shard_id", shard_name(F.lit(prefix), F.col("shard_id")).alias("shard"), "path", "rows", "bytes"
    )


def number_shards(spark: SparkSession, path: str, prefix: str = TRANSLATE_PREFIX) -> int:
    """Rename a batch output's files to `prefix-00000.parquet` and so on; returns the next free number.

    Numbers go on after the highest one present, in path order, so a call that
    breaks off can be repeated. One rename per file and no data is read, but
    object stores copy on rename: prefer `shard_manifest` there. Not for
    streaming outputs, whose log lists files by name.
    """
    number = next_shard_number(spark, path, prefix)
    files = list_files(spark, path, "*.parquet")
    unnumbered = files.where(shard_number(F.col("name"), prefix).isNull()).orderBy("path").select("path")
    for row in unnumbered.toLocalIterator():
        rename(spark, row["path"], f"{path.rstrip('/')}/{prefix}-{number:05d}.parquet")
        number += 1
    return number


def reshard_for_publish(
    spark: SparkSession,
    data_dir: str,
    out: str,
    split: str = PUBLISH_SPLIT,
    max_shard_size: str | int = PUBLISH_MAX_SHARD,
    fill: float = FILL,
) -> DataFrame:
    """Rewrite parquet files as one split of shards below a size, in sorted-file order; returns the manifest.

    A row's place in bytes is known from its file: bytes of earlier files plus its share of its own, by the rows before it.
    Cutting that line into equal lengths gives the shard, so files of long texts get more shards, and no pass over the
    texts is needed to plan it. Rows of one file vary in size, so the written shards are measured, and those over the size,
    unless they hold a single row, are split where they stand.
    """
    df = spark.read.parquet(*scan_targets(spark, data_dir))
    target, limit = f"{out.rstrip('/')}/{split}", parse_size(max_shard_size)
    write_shards(df, df.columns, F.lit(1), max(1, int(limit * fill)), target, "errorifexists", _parquet)
    split_files_over(spark, target, limit, fill, _parquet)
    return shard_manifest(spark, target, split)
