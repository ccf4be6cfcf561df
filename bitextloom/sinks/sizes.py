"""Files below a size: rows placed on the line of stored bytes, cut into shards, measured, and split only where over."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, NumericType, StringType

from bitextloom.prefix import running_total
from bitextloom.sources.paths import list_files, path_exists, remove, rename
from bitextloom.sources.positions import BROADCAST_FILES, file_count, file_path, row_index

# Runs of rows that a file's bytes are shared out by.
RUNS_PER_FILE = 64
# Files over the size that one round splits; there are as many rounds as it takes.
FILES_PER_ROUND = 10_000
WEIGHT = "_weight"


def row_weight(df: DataFrame) -> Column:
    """Bytes of a row before it is stored: those of its strings, eight for each other value."""
    parts = [F.lit(1)]
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(column), F.lit(0)))
        elif isinstance(field.dataType, NumericType):
            parts.append(F.lit(8))
        else:
            parts.append(F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(8)))
    return sum(parts[1:], parts[0]).cast("bigint")


def byte_runs(df: DataFrame, weight: Column) -> tuple[DataFrame, int, int]:
    """Runs of rows of a parquet scan with the bytes stored for them, the rows of a run, and all bytes.

    `_file, _run, rows, bytes, before`. The size model: a file's stored bytes, shared out over its runs by the weight of their
    rows. So what the codec makes of each part of the data is measured where it lies. `before` has the bytes of all earlier runs.
    """
    files = file_count(df)
    # The rows come from footers.
    length = max(1, df.count() // max(1, files * RUNS_PER_FILE))
    run = F.expr(f"_metadata.row_index div {length}").alias("_run")
    runs = df.groupBy(file_path().alias("_file"), run, F.col("_metadata.file_size").alias("_size")).agg(
        F.sum(weight).alias("_sum"), F.count(F.lit(1)).alias("rows")
    )
    whole = runs.groupBy("_file").agg(F.sum("_sum").alias("_whole"))
    if files <= BROADCAST_FILES:
        whole = F.broadcast(whole)
    shared = F.col("_size") * F.col("_sum") / F.greatest(F.col("_whole"), F.lit(1))
    runs = runs.join(whole, "_file").select("_file", "_run", "rows", shared.alias("bytes"))
    placed = running_total(runs, ["_file", "_run"], "bytes", "before", (RUNS_PER_FILE + 2) * files)
    total = shared_total(df)
    return placed, length, total


def shared_total(df: DataFrame) -> int:
    """Bytes of all files of a scan that have rows; from footers."""
    sizes = df.select(file_path().alias("_file"), F.col("_metadata.file_size").alias("_size")).distinct()
    return sizes.agg(F.coalesce(F.sum("_size"), F.lit(0))).first()[0]


def write_shards(df: DataFrame, names: list[str], weight: Column, shard_bytes: int, target: str, mode: str, writer) -> None:
    """Rows of a parquet scan as consecutive shards of about equal predicted bytes, at most `shard_bytes`, in sorted-file order."""
    runs, length, total = byte_runs(df, weight)
    shards = max(1, -(-int(total) // shard_bytes))
    if file_count(df) * (RUNS_PER_FILE + 2) <= BROADCAST_FILES:
        runs = F.broadcast(runs)
    run = F.expr(f"_metadata.row_index div {length}").alias("_run")
    rows = df.select("*", file_path().alias("_file"), run, row_index().alias("_index")).join(runs, ["_file", "_run"])
    inside = (F.col("_index") - F.col("_run") * length) / F.col("rows")
    place = F.col("before") + inside * F.col("bytes")
    shard = F.least(F.floor(place * shards / F.lit(max(1, total))), F.lit(shards - 1)).cast("int")
    placed = rows.repartitionById(shards, shard).sortWithinPartitions("_file", "_index")
    writer(placed.select(*(f"`{name}`" for name in names)), target, mode)


def split_files_over(spark: SparkSession, path: str, limit: int, fill: float, writer) -> int:
    """Split the parquet files of a folder that are over `limit` bytes until none is, but for those of one row; returns how many were.

    A file's parts take its place in the order of names. They are written below the folder, where readers look past them, and renamed
    one by one before the file goes: a driver that is lost between the two leaves rows twice, never none.
    """
    split, single = 0, set()
    while True:
        files = list_files(spark, path, "*.parquet").where((F.col("bytes") > limit) & ~F.col("path").contains("/_"))
        over = [row for row in files.limit(FILES_PER_ROUND + len(single)).collect() if row["path"] not in single]
        if not over:
            return split
        rows = spark.read.parquet(*(row["path"] for row in over))
        counts = dict(rows.groupBy(file_path()).count().collect())
        pieces, first = [], 0
        for row in over:
            count = counts[row["path"]]
            parts = min(count, max(2, -(-row["bytes"] // max(1, int(limit * fill)))))
            if parts < 2:
                single.add(row["path"])
                continue
            pieces.append((row["path"], first, parts, count))
            first += parts
        if pieces:
            _replace(spark, path, rows, pieces, first, writer)
            split += len(pieces)


def _replace(spark: SparkSession, path: str, rows: DataFrame, pieces: list[tuple], total: int, writer) -> None:
    names = rows.columns
    table = spark.createDataFrame(pieces, "_file string, _first int, _parts bigint, _rows bigint")
    part = F.least(F.expr("_index * _parts div _rows"), F.col("_parts") - 1).cast("int")
    # At most FILES_PER_ROUND rows.
    marked = rows.select("*", file_path().alias("_file"), row_index().alias("_index")).join(F.broadcast(table), "_file")
    dealt = marked.repartitionById(total, F.col("_first") + part).sortWithinPartitions("_index")
    below = f"{path.rstrip('/')}/_split-{uuid.uuid4().hex}"
    writer(dealt.select(*(f"`{name}`" for name in names)), below, "errorifexists")
    written = {int(row["name"].split("-")[1]): row["path"] for row in list_files(spark, below, "part-*.parquet").collect()}
    for file, first, parts, _ in pieces:
        stem, ending = re.fullmatch(r"(.*?)((?:\.\w+)?\.parquet)", file).groups()
        for i in range(parts):
            if first + i in written:
                rename(spark, written[first + i], f"{stem}.s{i:05d}{ending}")
        remove(spark, file)
    if path_exists(spark, below):
        remove(spark, below)
