"""Translate a corpus in input order, slice by slice, resumable by position or by key."""

from __future__ import annotations

import logging
import os
import uuid
from collections import deque
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.defaults import (
    API_IN_FLIGHT,
    API_MODEL,
    FALLBACK_TIER,
    FILTERED_COLUMN,
    JSONL_LOCAL_IN_FLIGHT,
    LOCAL_BASE_URL,
    LOCAL_IN_FLIGHT,
    LOCAL_MODEL,
    MAX_COMPLETION_TOKENS,
    SOURCE_COLUMN,
    TARGET_COLUMN,
    TEMPERATURE,
)
from bitextloom.functions.rates import Limits, resolve_limits
from bitextloom.operators.backends import Backend, ChatBackend, api_chat, local_chat
from bitextloom.operators.enrich import enrich_text, enrich_to_table, hybrid_enrich, rate_budgeted_enrich, sized_request
from bitextloom.operators.resume import pending_ranges, resume_pending
from bitextloom.session import scratch_path
from bitextloom.sinks.parquet import write_ordered
from bitextloom.sources.paths import expand_paths, fingerprint, list_files, path_exists, remove, scan_targets, split_list
from bitextloom.sources.positions import file_offsets, first_jsonl_rows, rows_between, stage_jsonl
from bitextloom.sources.readers import parse_jsonl
from bitextloom.sources.state import StateLog

# Rows of a committed slice, and slices in flight: their product is the work lost at most when a run dies.
SLICE_ROWS = 20_000
SLICES_IN_FLIGHT = 4
# Minutes of calls in a slice of a run with a rate budget.
SLICE_MINUTES = 10
MANIFEST = "first bigint, last bigint, written bigint, errors bigint"

Translate = Callable[[DataFrame], DataFrame]

LOG = logging.getLogger(__name__)


@dataclass(frozen=True)
class TranslationSettings:
    """Servers, models and limits of the named backends."""

    urls: tuple[str, ...] = (LOCAL_BASE_URL,)
    local_model: str = LOCAL_MODEL
    local_in_flight: int = LOCAL_IN_FLIGHT
    api_url: str = ""
    api_model: str = API_MODEL
    api_in_flight: int = API_IN_FLIGHT
    temperature: float = TEMPERATURE
    max_tokens: int = MAX_COMPLETION_TOKENS
    limits: Limits = resolve_limits()
    backend: str = "gpt-oss"

    @classmethod
    def from_environment(
        cls,
        env: Mapping[str, str] = os.environ,
        model: str | None = None,
        tier: str | None = None,
        rpm: int | None = None,
        tpm: int | None = None,
        jsonl: bool = False,
    ) -> TranslationSettings:
        """Settings from the usual variables of the client library; arguments win.

        `jsonl` takes the wider default of calls in flight for JSON-lines sources.
        """
        listed = tuple(split_list(env.get("OPENAI_BASE_URLS", "")))
        in_flight = int(env.get("TARGET_IN_FLIGHT", JSONL_LOCAL_IN_FLIGHT)) if jsonl else LOCAL_IN_FLIGHT
        return cls(
            urls=listed or (env.get("OPENAI_BASE_URL", LOCAL_BASE_URL),),
            local_model=model or env.get("GPT_OSS_MODEL", env.get("OPENAI_MODEL", LOCAL_MODEL)),
            local_in_flight=max(1, in_flight),
            api_url=env.get("OPENAI_API_BASE_URL", "").strip(),
            api_model=model or env.get("OPENAI_API_MODEL", API_MODEL),
            api_in_flight=max(1, int(env.get("OPENAI_API_IN_FLIGHT", API_IN_FLIGHT))),
            temperature=float(env.get("OPENAI_TEMPERATURE", TEMPERATURE)),
            max_tokens=int(env.get("OPENAI_MAX_TOKENS", MAX_COMPLETION_TOKENS)),
            backend=env.get("TRANSLATION_BACKEND", "gpt-oss"),
            limits=resolve_limits(
                tier or env.get("OPENAI_RATE_TIER", FALLBACK_TIER),
                rpm,
                tpm,
                env.get("OPENAI_RPM", ""),
                env.get("OPENAI_TPM", ""),
            ),
        )

    def slice_rows(self) -> int:
        """Rows that the rate budget admits in some minutes."""
        a_minute = min(self.limits.rpm, self.limits.tpm // sized_request(1, self.max_tokens))
        return max(1, a_minute) * SLICE_MINUTES

    def local(self) -> ChatBackend:
        return local_chat(
            self.urls,
            self.local_model,
            max_in_flight=self.local_in_flight,
            temperature=self.temperature,
            max_tokens=self.max_tokens,
        )

    def remote(self, alone: bool = False) -> ChatBackend:
        """The remote service; alone it has the general number of calls in flight, beside others its own."""
        in_flight = self.local_in_flight if alone else self.api_in_flight
        return api_chat(self.api_url, self.api_model, max_in_flight=in_flight, max_tokens=self.max_tokens)


@dataclass(frozen=True)
class Budgeted:
    """A translator that spends a rate budget: one frame at a time, and small ones."""

    translate: Translate
    slice_rows: int

    def __call__(self, df: DataFrame) -> DataFrame:
        return self.translate(df)


def translator(
    backend: str | Backend | None = None,
    key: str = "ordinal",
    settings: TranslationSettings | None = None,
    on_error: str = "blank",
    tasks: int | None = None,
) -> Translate:
    """What to do with a frame of `key, text`: one of the named backends, or any other.

    Without one, the settings name it. Names: `gpt-oss` (own servers), `openai-api` (remote, within its rate
    budget), `hybrid` (both, by their capacities, the remote one within its
    budget). `tasks` bounds the tasks that call at once.
    """
    settings = settings or TranslationSettings()
    backend = backend or settings.backend
    options = {"on_error": on_error, "tasks": tasks}
    if isinstance(backend, Backend):
        return lambda df: enrich_text(df, backend, key, **options)
    if backend == "gpt-oss":
        return lambda df: enrich_text(df, settings.local(), key, **options)
    remote = settings.remote(alone=backend == "openai-api")
    if backend == "openai-api":
        return Budgeted(lambda df: rate_budgeted_enrich(df, remote, settings.limits, key, **options), settings.slice_rows())
    if backend == "hybrid":
        both, limits = [settings.local(), remote], {remote.name: settings.limits}
        return Budgeted(lambda df: hybrid_enrich(df, both, key, limits=limits, **options), settings.slice_rows())
    raise ValueError(f"unsupported backend: {backend}")


def translate_corpus(
    spark: SparkSession,
    data_files: str,
    out: str,
    translate: Translate,
    state_path: str,
    input_column: str = FILTERED_COLUMN,
    source_name: str = SOURCE_COLUMN,
    target_name: str = TARGET_COLUMN,
    max_samples: int = -1,
    slice_rows: int | None = None,
    source_format: str = "parquet",
    in_flight: int = SLICES_IN_FLIGHT,
) -> int:
    """Translate rows the output does not hold yet, in input order; returns the rows it holds then.

    Rows are cut into small slices by position, and `in_flight` of them run at a
    time, so the cluster does not drain between them; a translator with a rate
    budget runs one at a time, as each job would spend all of it. The calls of a
    slice are the last stage of a job that only stores their results: what is
    done afterwards, placing rows in order and writing them, repeats no call.

    A slice commits as `out/slice=<first position>/`, two text columns in
    input order; the status of its rows goes to `state_path/status`, and last a
    row of the manifest (`state_path/manifest`) makes it count, with range, rows
    and errors. A run resumes from the manifest: what it lacks, or what lost its
    folder, is translated, whatever success marks a committer left. For
    `source_format="json"`, `input_column` is the field of the records.
    """
    paths = scan_targets(spark, data_files, {"parquet": ".parquet", "json": ".json*"}[source_format])
    if source_format == "json":
        df, input_column = _jsonl_in_order(spark, data_files, paths, input_column, max_samples, state_path), "text"
    else:
        df = spark.read.parquet(*paths)
    text = F.col(input_column) if dict(df.dtypes)[input_column] == "string" else F.lit(None).cast("string")
    offsets = _stored_offsets(df)
    total = offsets.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
    end = min(total, max_samples) if max_samples >= 0 else total
    budgeted = getattr(translate, "slice_rows", None)
    size = slice_rows or budgeted or SLICE_ROWS
    manifest, lock = StateLog(spark, f"{state_path}/manifest", MANIFEST), Lock()
    done = _committed(spark, manifest, out)

    def run(piece: tuple[int, int]) -> None:
        first, last = piece
        rows = rows_between(df, first, last, offsets).select("ordinal", text.alias("text"))
        results = f"{state_path}/results/slice={first:015d}"
        stored = enrich_to_table(translate(rows), results, mode="overwrite")
        status = [name for name in ("ordinal", "status", "error", "attempts", "backend") if name in stored.columns]
        stored.select(*status).write.mode("overwrite").parquet(f"{state_path}/status/slice={first:015d}")
        pair = stored.select(
            (F.col("ordinal") - first).alias("ordinal"),
            F.col(SOURCE_COLUMN).alias(source_name),
            F.col(TARGET_COLUMN).alias(target_name),
        )
        write_ordered(pair, f"{out}/slice={first:015d}", total_rows=last - first, mode="overwrite", keep_ordinal=False)
        errors = stored.where("status = 'error'").count() if "status" in status else 0
        with lock:
            manifest.append(first=first, last=last, written=last - first, errors=errors)
        remove(spark, results)
        LOG.info("rows %s to %s of %s stored, %s failed", first, last, end, errors)

    # Stored, for the manifest grows while the slices run; the driver holds those in flight.
    pending = scratch_path(spark, "pending")
    pending_ranges(done, end, size).write.parquet(pending)
    width, waiting = 1 if budgeted else max(1, in_flight), deque()
    with ThreadPoolExecutor(width) as pool:
        for piece in spark.read.parquet(pending).orderBy("first").toLocalIterator():
            waiting.append(pool.submit(run, (piece["first"], piece["last"])))
            while len(waiting) > 2 * width:
                waiting.popleft().result()
        while waiting:
            waiting.popleft().result()
    return _committed(spark, manifest, out).agg(F.coalesce(F.sum(F.col("last") - F.col("first")), F.lit(0))).first()[0]


def _committed(spark: SparkSession, manifest: StateLog, out: str) -> DataFrame:
    """Ranges `first, last` of the manifest whose folder is there; a slice translated again counts once."""
    newest = manifest.read().groupBy("first").agg(F.max_by("last", "version").alias("last"))
    if not path_exists(spark, out):
        return newest.where(F.lit(False))
    slices = list_files(spark, out, "*.parquet").select(F.regexp_extract("path", r"/slice=(\d+)/[^/]*$", 1).alias("name"))
    there = slices.where("name <> ''").select(F.col("name").cast("bigint").alias("first")).distinct()
    return newest.join(there, "first", "left_semi").select("first", "last")


def translation_status(spark: SparkSession, state_path: str) -> DataFrame:
    """ordinal, status, error and attempts of every translated row; `enrich_report` counts it, failed rows are found by it."""
    return spark.read.parquet(f"{state_path}/status").drop("slice")


def translation_progress(spark: SparkSession, state_path: str) -> DataFrame:
    """One row: slices, rows written, errors and the time of the newest commit, of a run that goes on or has ended."""
    return StateLog(spark, f"{state_path}/manifest", MANIFEST).read().dropDuplicates(["first"]).agg(
        F.count(F.lit(1)).alias("slices"),
        F.coalesce(F.sum("written"), F.lit(0)).alias("written"),
        F.coalesce(F.sum("errors"), F.lit(0)).alias("errors"),
        F.max("updated_at").alias("updated_at"),
    )


def _jsonl_in_order(
    spark: SparkSession, spec: str, paths: list[str], field: str, cap: int, state_path: str
) -> DataFrame:
    """JSON lines laid out as parquet in input order, so that they have positions.

    Stored beside the state and used again by later runs over the same files,
    field and cap; a capped run lays out no more lines than it needs.
    """
    files = expand_paths(spark, spec, suffix=".json*")
    mark = f"{fingerprint(spark, files)} {field} {cap}"
    log = StateLog(spark, f"{state_path}/staging", "mark string, place string")
    known = log.read().where(F.col("mark") == mark).first()
    if known and path_exists(spark, known["place"]):
        return spark.read.parquet(known["place"])
    place = f"{state_path}/lines/{uuid.uuid4().hex}"
    lines = first_jsonl_rows(spark, files, cap) if cap >= 0 else stage_jsonl(spark, paths)
    write_ordered(parse_jsonl(lines, field), place, total_rows=lines.count())
    log.append(mark=mark, place=place)
    return spark.read.parquet(place)


def _stored_offsets(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "offsets")
    file_offsets(df).write.parquet(path)
    return df.sparkSession.read.parquet(path)


def translate_pending(
    source: DataFrame, out: str, translate: Translate, key: str, mode: str = "append"
) -> DataFrame:
    """Keyed resume: translate rows whose key the output lacks, append them, return the output."""
    spark = source.sparkSession
    pending = source
    if path_exists(spark, out):
        pending = resume_pending(source, spark.read.parquet(out), key)
    translate(pending).write.mode(mode).option("compression", "zstd").parquet(out)
    return spark.read.parquet(out)

