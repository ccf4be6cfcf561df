"""JSON-lines and parquet scans."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.defaults import FILTERED_COLUMN, TEXT_FIELD
from bitextloom.sources.paths import expand_paths, infer_format, scan_targets
from bitextloom.sources.positions import file_path, first_jsonl_rows, take_first_rows


def scan_jsonl(
    spark: SparkSession,
    paths: str | list[str],
    text_field: str = TEXT_FIELD,
    keep: str = "",
) -> DataFrame:
    """Rows of JSON-lines files: the text field, plus the `keep` columns (a DDL list).

    The field is read as a variant so that a number or an object in its place
    is told from a string: only strings are texts, anything else (and a line
    that is not JSON) is null. Only the named fields are parsed.
    """
    return _texts_only(spark.read.schema(_jsonl_schema(text_field, keep)).json(paths), text_field)


def stream_jsonl(
    spark: SparkSession,
    folder: str,
    text_field: str = TEXT_FIELD,
    keep: str = "",
    pattern: str = "*.json*",
    files_per_batch: int = 1000,
) -> DataFrame:
    """Stream of a folder's JSON-lines files, read like `scan_jsonl`."""
    reader = spark.readStream.schema(_jsonl_schema(text_field, keep)).option("pathGlobFilter", pattern)
    return _texts_only(reader.option("maxFilesPerTrigger", files_per_batch).json(folder), text_field)


def _jsonl_schema(text_field: str, keep: str) -> str:
    return f"`{text_field}` variant" + (f", {keep}" if keep else "")


def _texts_only(rows: DataFrame, text_field: str) -> DataFrame:
    return rows.withColumn(text_field, _string_or_null(F.col(f"`{text_field}`")))


def parse_jsonl(lines: DataFrame, text_field: str = TEXT_FIELD, alias: str = "text") -> DataFrame:
    """Replace a column `value` of JSON lines by its text field, read as in `scan_jsonl`."""
    record = F.from_json("value", f"`{text_field}` variant")
    return lines.withColumn(alias, _string_or_null(record[text_field])).drop("value")


def _string_or_null(value: Column) -> Column:
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(value, "$", "string"))


def scan_parquet(spark: SparkSession, paths: str | list[str], column: str = FILTERED_COLUMN) -> DataFrame:
    """The text column of parquet files; no other column is read."""
    files = [paths] if isinstance(paths, str) else paths
    return spark.read.parquet(*files).select(column)


def resolve_text_field(columns: list[str], requested: str = TEXT_FIELD) -> str:
    """The column to read: the default name falls back to the filtered corpus' name."""
    falls_back = requested == TEXT_FIELD and requested not in columns and FILTERED_COLUMN in columns
    return FILTERED_COLUMN if falls_back else requested


def with_text(
    df: DataFrame, requested: str = TEXT_FIELD, alias: str = "text", fall_back: bool = True
) -> DataFrame:
    """Add the resolved text column as `alias`; all null when the table has no such column of strings."""
    field = resolve_text_field(df.columns, requested) if fall_back else requested
    # As in JSON lines, only strings are texts: a number in the field's place is a missing text.
    kinds = dict(df.dtypes)
    text = F.col(f"`{field}`") if kinds.get(field) == "string" else F.lit(None).cast("string")
    return df.withColumn(alias, text)


def scan_corpus(
    spark: SparkSession,
    data_files: str,
    requested_format: str = "auto",
    text_field: str = TEXT_FIELD,
    cap: int = -1,
    fall_back: bool = True,
) -> DataFrame:
    """Texts of a corpus in either format as one column `text`; the first `cap` rows if not negative.

    With `fall_back`, the default field gives way to the filtered corpus' name
    when the data lacks it; without, all texts are then missing.
    """
    if infer_format(data_files, requested_format) == "parquet":
        paths = scan_targets(spark, data_files)
        rows = take_first_rows(spark.read.parquet(*paths), cap)
        return with_text(rows, text_field, fall_back=fall_back).select("text")
    paths = scan_targets(spark, data_files, suffix=".json*")
    field = resolve_text_field(_first_keys(spark, data_files), text_field) if fall_back else text_field
    if cap >= 0:
        paths = expand_paths(spark, data_files, suffix=".json*")
        return parse_jsonl(first_jsonl_rows(spark, paths, cap), field).select("text")
    return scan_jsonl(spark, paths, field).select(F.col(f"`{field}`").alias("text"))


def _first_keys(spark: SparkSession, spec: str) -> list[str]:
    """Keys of the first record in sorted-file order; files without one are passed over, in growing groups."""
    paths, start, size = expand_paths(spark, spec, suffix=".json*"), 0, 1
    while start < len(paths):
        lines = spark.read.text(paths[start : start + size]).where(F.trim("value") != "")
        path = lines.agg(F.min(file_path())).first()[0]
        if path is not None:
            first = lines.where(file_path() == path).limit(1)
            return list(first.select(F.json_object_keys("value").alias("keys")).first()["keys"] or [])
        start, size = start + size, size * 2
    return []


def union_sources(*frames: DataFrame) -> DataFrame:
    """Rows of all frames by column name; duplicates stay, missing columns are null."""
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)
