"""Input paths: formats, patterns and file listings on any Hadoop file system."""

from __future__ import annotations

import re
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed values: spellings that mark a parquet path
PARQUET_MARKS = (".parquet", ".pq")


def split_list(spec: str) -> list[str]:
    """Entries of a comma-separated list, trimmed, blanks left out."""
    return list(filter(None, map(str.strip, spec.split(","))))


def infer_format(path: str, requested: str = "auto") -> str:
    """`json` or `parquet`: an explicit request wins, else the path's spelling decides."""
    spelled = "parquet" if any(mark in path.lower() for mark in PARQUET_MARKS) else "json"
    return spelled if requested == "auto" else requested


def infer_format_column(path: Column, requested: Column) -> Column:
    """Column form of `infer_format`, for a table of paths."""
    marked = [F.contains(F.lower(path), F.lit(mark)) for mark in PARQUET_MARKS]
    spelled = F.when(reduce(or_, marked), "parquet").otherwise("json")
    return F.when(requested == "auto", spelled).otherwise(requested)


def _hadoop_path(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop)


def is_directory(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop) and fs.getFileStatus(hadoop).isDirectory()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder this library wrote and no longer needs."""
    hadoop, fs = _hadoop_path(spark, path)
    fs.delete(hadoop, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    hadoop, fs = _hadoop_path(spark, source)
    if not fs.rename(hadoop, spark._jvm.org.apache.hadoop.fs.Path(target)):
        raise OSError(f"cannot rename {source} to {target}")


def expand_paths(spark: SparkSession, spec: str, suffix: str = ".parquet") -> list[str]:
    """Files of a comma-separated spec, sorted and without duplicates.

    A directory stands for its `*.parquet` files, a wildcard for its matches, a
    plain file for itself if it exists. Blanks and misses are skipped. Paths
    keep their scheme only if the spec gave one.
    """
    patterns = [_pattern(spark, entry, suffix) for entry in split_list(spec)]
    return sorted({path for pattern in patterns for path in _glob(spark, pattern)})


def _pattern(spark: SparkSession, entry: str, suffix: str) -> str:
    return f"{entry.rstrip('/')}/*{suffix}" if is_directory(spark, entry) else entry


def _glob(spark: SparkSession, pattern: str) -> list[str]:
    hadoop, fs = _hadoop_path(spark, pattern)
    matches = spark._jvm.org.apache.spark.deploy.SparkHadoopUtil.get().globPath(fs, hadoop)
    if matches.isEmpty():
        return []
    # One string for all names: a call per file would take minutes for a large folder.
    paths = matches.mkString("\n").split("\n")
    if "://" not in pattern:
        paths = [re.sub(r"^\w+:(//[^/]*)?", "", path) for path in paths]
    keep_hidden = pattern.rsplit("/", 1)[-1].startswith(".")
    return [path for path in paths if keep_hidden or not path.rsplit("/", 1)[-1].startswith(".")]


def scan_targets(spark: SparkSession, spec: str, suffix: str = ".parquet") -> list[str]:
    """What to hand to a reader for a spec; raises when nothing matches.

    A single pattern stays a pattern, which the reader expands by itself;
    several are expanded here, as a file named twice must be read once.
    """
    entries = split_list(spec)
    if len(entries) == 1:
        pattern = _pattern(spark, entries[0], suffix)
        hadoop, fs = _hadoop_path(spark, pattern)
        targets = [pattern] if fs.globStatus(hadoop) else []
    else:
        targets = expand_paths(spark, spec, suffix)
    if not targets:
        raise FileNotFoundError(f"no files matched: {spec}")
    return targets


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """One row per file below `path`: path, name, bytes, modified. Contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select(
        "path",
        F.element_at(F.split("path", "/"), -1).alias("name"),
        F.col("length").alias("bytes"),
        F.col("modificationTime").alias("modified"),
    )


def fingerprint(spark: SparkSession, paths: list[str]) -> str:
    """A digest of names, sizes and times of the files: it changes when an input changes."""
    files = spark.read.format("binaryFile").load(paths)
    row = files.agg(
        F.count("*").alias("n"),
        F.bit_xor(F.xxhash64("path", "length", "modificationTime")).alias("mix"),
        F.sum("length").alias("bytes"),
    ).first()
    return f"{row['n']}-{row['bytes']}-{row['mix']}"


def include_patterns(spark: SparkSession, root: str, *patterns: str) -> list[str]:
    """Files of a dataset folder that match any of the patterns, e.g. `en/*.json.gz`."""
    return sorted({path for pattern in patterns for path in _glob(spark, f"{root.rstrip('/')}/{pattern}")})
