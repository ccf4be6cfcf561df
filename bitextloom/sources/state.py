"""Small run state, one row per save, in a table of its own.

Saves are appended, so a save that fails leaves the previous one in force. Keep
the table outside the data folder: a reader of the data must not find it.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from bitextloom.sources.paths import path_exists

PROGRESS = "processed bigint, written bigint, shard_id bigint"


class StateLog:
    """One writer at a time; it reads the stored saves once and then remembers its own."""

    def __init__(self, spark: SparkSession, path: str, fields: str = PROGRESS):
        self.spark = spark
        self.path = path
        self.schema = f"version bigint, updated_at bigint, {fields}"
        self._newest: Row | None = None

    def read(self) -> DataFrame:
        """All saves; unreadable files of the table are skipped."""
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).option("ignoreCorruptFiles", True).parquet(self.path)

    def latest(self) -> Row | None:
        """The newest save, or None."""
        if self._newest is None:
            self._newest = self.read().orderBy(F.desc("version")).limit(1).first()
        return self._newest

    def append(self, **fields) -> None:
        """Save one row, with the time in epoch seconds."""
        last = self.latest()
        row = Row(version=last["version"] + 1 if last else 0, updated_at=int(time.time()), **fields)
        values = [F.lit(value).alias(name) for name, value in row.asDict().items()]
        typed = self.spark.range(1).select(*values).to(StructType.fromDDL(self.schema))
        typed.coalesce(1).write.mode("append").parquet(self.path)
        self._newest = row
