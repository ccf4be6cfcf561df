"""Session helpers: sensible settings, scratch folders, scoped settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Texts vary from a few bytes to megabytes: bound Arrow batches by rows and bytes.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1024",
    "spark.sql.execution.arrow.maxBytesPerBatch": "64m",
    # A speculative copy of an enrichment task would call the model twice.
    "spark.speculation": "false",
    # A wave of budgeted calls that the cluster has no slots for fails the first time it is looked at.
    "spark.scheduler.barrier.maxConcurrentTasksCheck.maxFailures": "1",
}


def build_session(app: str = "bitextloom", master: str | None = None, **extra: str) -> SparkSession:
    """A session with this library's settings; `extra` uses `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {key.replace("__", "."): value for key, value in extra.items()}
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by `spark.checkpoint.dir`.

    Only a local session that names none (unit tests) gets a folder of its own;
    on a cluster that would be a different disk on each machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    local = context.master == "local" or context.master.startswith("local[")
    if not context.getCheckpointDir() and not local:
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    if not context.getCheckpointDir():
        context.setCheckpointDir(tempfile.mkdtemp(prefix="run-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unused path below the shared folder."""
    return f"{shared_folder(spark)}/bitextloom/{label}-{uuid.uuid4().hex}"


@contextmanager
def scoped_conf(spark: SparkSession, **settings: str) -> Iterator[None]:
    """Set SQL settings (`__` for dots) and put the old ones back afterwards."""
    wanted = {key.replace("__", "."): value for key, value in settings.items()}
    before = {key: spark.conf.get(key, None) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
