"""Row counts from footers, and a count kept between runs that only counts what is new."""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from bitextloom.session import scoped_conf
from bitextloom.sources.paths import fingerprint, path_exists
from bitextloom.sources.positions import BROADCAST_FILES, file_path
from bitextloom.sources.state import StateLog

# Counts read no column; a scan must name one, though.
NO_COLUMN = "_none int"
COUNTED = "path string, bytes bigint, modified timestamp, column string, rows bigint, counted_at bigint"


def footer_count(spark: SparkSession, paths: list[str], *more: Column) -> DataFrame:
    """One row, `rows`: the sum of the footers' counts. The scan answers it itself, so no row is made (PushedAggregation).

    Collect it within `pushdown`.
    """
    return spark.read.schema(NO_COLUMN).parquet(*paths).agg(F.count(F.lit(1)).alias("rows"), *more)


def pushdown(spark: SparkSession):
    """Settings under which parquet scans answer counts from footers: the second source interface, with aggregates."""
    kinds = spark.conf.get("spark.sql.sources.useV1SourceList").split(",")
    return scoped_conf(
        spark,
        spark__sql__sources__useV1SourceList=",".join(kind for kind in kinds if kind != "parquet"),
        spark__sql__parquet__aggregatePushdown="true",
    )


def _footer_rows(spark: SparkSession, paths: list[str]) -> int | None:
    """Rows of the files; None when one is unreadable."""
    if not paths:
        return 0
    try:
        with pushdown(spark):
            return footer_count(spark, paths).first()["rows"]
    except (PySparkException, Py4JJavaError):
        return None


def unreadable_files(spark: SparkSession, paths: list[str]) -> list[str]:
    """The files whose footers cannot be read: halves that hold none are passed over as a whole."""
    if _footer_rows(spark, paths) is not None:
        return []
    if len(paths) == 1:
        return paths
    middle = len(paths) // 2
    return unreadable_files(spark, paths[:middle]) + unreadable_files(spark, paths[middle:])


def rows_per_file(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    """path and rows of every readable file that has any; no column is read. Unreadable files are left out."""
    reader = spark.read.schema(NO_COLUMN).option("ignoreCorruptFiles", True)
    files = reader.parquet(*([paths] if isinstance(paths, str) else paths))
    return files.groupBy(file_path().alias("path")).agg(F.count(F.lit(1)).alias("rows"))


def files_without(spark: SparkSession, paths: list[str], column: str, rows: DataFrame) -> DataFrame:
    """path of the files of `rows` (path, rows) that lack a column of the name.

    To a scan a missing column is all null. Row groups without a null are passed over by their statistics,
    so whole texts are read only beside nulls; the files that are null throughout are then read with a default
    for the missing column, which nulls that are stored do not get.
    """
    typed = {field.name: field for field in spark.read.parquet(*paths).schema.fields}
    if column not in typed:
        return rows.select("path")
    schema = StructType([typed[column]])
    nulls = spark.read.schema(schema).parquet(*paths).where(F.col(f"`{column}`").isNull())
    nulls = nulls.groupBy(file_path().alias("path")).agg(F.count(F.lit(1)).alias("nulls"))
    suspects = [row["path"] for row in nulls.join(rows, "path").where("nulls = rows").select("path").collect()]
    if not suspects:
        return rows.select("path").where(F.lit(False))
    mark = uuid.uuid4().hex
    default = {"CURRENT_DEFAULT": f"'{mark}'", "EXISTS_DEFAULT": f"'{mark}'"}
    # Read as text whatever its kind: the values do not matter, and only files without one get the mark.
    with scoped_conf(spark, spark__sql__parquet__filterPushdown="false"):
        filled = spark.read.schema(StructType([StructField(column, StringType(), True, default)])).parquet(*suspects)
        found = filled.where(F.col(f"`{column}`") == mark).select(file_path().alias("path")).distinct().collect()
    return spark.createDataFrame([(row["path"],) for row in found], "path string")


def count_rows_parquet(spark: SparkSession, paths: list[str], column: str) -> int | None:
    """Rows from the footers; None when a file is unreadable or lacks the column."""
    rows = _footer_rows(spark, paths)
    if not rows:
        return rows
    return rows if files_without(spark, paths, column, rows_per_file(spark, paths)).isEmpty() else None


def count_rows_jsonl(spark: SparkSession, paths: str | list[str]) -> int:
    """Lines of the files; an unterminated last line counts."""
    return spark.read.text(paths).count()


def counted_files(spark: SparkSession, state_path: str) -> DataFrame:
    """The table of files counted so far, beside the state."""
    path = f"{state_path.rstrip('/')}-files"
    if not path_exists(spark, path):
        return spark.createDataFrame([], COUNTED)
    return spark.read.schema(COUNTED).parquet(path)


def count_new_files(spark: SparkSession, state_path: str, paths: list[str], column: str) -> int | None:
    """Rows of all files, of which only new and changed ones are opened; None as `count_rows_parquet`.

    The listing, anti-joined with the table of counted files by path, size and time, says which those are. What
    they hold is added to the table, so a file is opened once however many runs follow.
    """
    listing = spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("bytes"), F.col("modificationTime").alias("modified"))
    known = counted_files(spark, state_path).where(F.col("column") == column)
    fresh = listing.join(known, ["path", "bytes", "modified"], "left_anti")
    opened = [row["path"] for row in fresh.select("path").collect()]
    if opened:
        if count_rows_parquet(spark, opened, column) is None:
            return None
        rows = rows_per_file(spark, opened)
        if len(opened) <= BROADCAST_FILES:
            rows = F.broadcast(rows)
        counted = fresh.join(rows, "path", "left").select(
            "path", "bytes", "modified", F.lit(column).alias("column"), F.coalesce("rows", F.lit(0)).alias("rows"), F.lit(int(time.time())).cast("bigint").alias("counted_at")
        )
        counted.coalesce(1).write.mode("append").parquet(f"{state_path.rstrip('/')}-files")
        known = counted_files(spark, state_path).where(F.col("column") == column)
    # A run that broke off may have added a file twice.
    once = known.dropDuplicates(["path", "bytes", "modified"])
    return listing.join(once, ["path", "bytes", "modified"]).agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]


def cached_count(
    spark: SparkSession, state_path: str, pattern: str, paths: list[str], column: str
) -> int | None:
    """Row count of a pattern, stored between runs.

    The stored count holds only while pattern and files are the same; otherwise new and changed files
    are counted, the others are known from the table beside the state. An unknown count is not stored.
    """
    log = StateLog(spark, state_path, "pattern string, files string, count bigint")
    mark = fingerprint(spark, paths)
    stored = log.latest()
    if stored and stored["pattern"] == pattern and stored["files"] == mark:
        return stored["count"]
    count = count_new_files(spark, state_path, paths, column)
    if count is not None:
        log.append(pattern=pattern, files=mark, count=count)
    return count


def resolve_max_samples(
    spark: SparkSession,
    max_samples: int,
    state_path: str,
    pattern: str,
    paths: list[str],
    column: str,
) -> int | None:
    """The cap of a run: an explicit one, else the (cached) row count, else unknown."""
    if max_samples >= 0:
        return max_samples
    return cached_count(spark, state_path, pattern, paths, column)
