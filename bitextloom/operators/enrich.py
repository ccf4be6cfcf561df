"""Enrichment: one model call per row, with retries, row-level errors and rate budgets.

Rows flow through `mapInPandas`: the key travels with its row, so order and
identity need no bookkeeping. Tasks may be run again, and then call again:
write a result once and read it back instead of computing it twice.
"""

from __future__ import annotations

import time
import warnings
from collections import deque
from collections.abc import Callable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor
from contextlib import ExitStack
from queue import SimpleQueue
from threading import Lock

import pandas as pd
from pyspark.resource import ResourceProfile, ResourceProfileBuilder, TaskResourceRequests
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bitextloom.defaults import (
    MAX_COMPLETION_TOKENS,
    MAX_RETRIES,
    RATE_WINDOW_SECONDS,
    RETRY_STEP_SECONDS,
    SOURCE_COLUMN,
    TARGET_COLUMN,
)
from bitextloom.functions.rates import Limits
from bitextloom.functions.retry import rate_limited, wait_from_message
from bitextloom.functions.tokens import BYTES_PER_TOKEN, prompt_base_tokens
from bitextloom.operators.backends import Backend, Call
from bitextloom.operators.filters import route_error_rows

# Rows of a batch that are called, and given on, at a time.
PART_ROWS = 256
RESULT = "text_ja string, status string, error string, attempts int"


class Budget:
    """Requests and tokens of one task over the last 60 seconds."""

    def __init__(self, limits: Limits, clock: Callable[[], float] = time.monotonic, sleep=time.sleep):
        self.limits, self.clock, self.sleep = limits, clock, sleep
        self.spent: deque[tuple[float, int]] = deque()
        self.tokens = 0
        self.lock = Lock()

    def delay(self, tokens: int, now: float) -> float:
        """Seconds until a request of this size fits; expired entries are dropped."""
        while self.spent and now - self.spent[0][0] >= RATE_WINDOW_SECONDS:
            self.tokens -= self.spent.popleft()[1]
        requests_over = len(self.spent) + 1 - self.limits.rpm
        tokens_over = self.tokens + tokens - self.limits.tpm
        if requests_over <= 0 and tokens_over <= 0:
            return 0.0
        for position, (at, freed) in enumerate(self.spent, start=1):
            tokens_over -= freed
            if position >= requests_over and tokens_over <= 0:
                return at + RATE_WINDOW_SECONDS - now
        return 0.0

    def spend(self, tokens: int) -> None:
        """Wait until the request fits, then book it."""
        tokens = max(1, min(tokens, self.limits.tpm))
        while True:
            with self.lock:
                now = self.clock()
                wait = self.delay(tokens, now)
                if wait <= 0:
                    self.spent.append((now, tokens))
                    self.tokens += tokens
                    return
            self.sleep(wait)


PROMPT_TOKENS = prompt_base_tokens()


def request_tokens(text: str, max_tokens: int = MAX_COMPLETION_TOKENS) -> int:
    """Per-row form of `estimate_request_tokens`."""
    return sized_request(len(text.encode("utf-8")), max_tokens)


def sized_request(size: int, max_tokens: int = MAX_COMPLETION_TOKENS) -> int:
    """Tokens of a request for a text of `size` bytes."""
    return PROMPT_TOKENS + (max(1, size // BYTES_PER_TOKEN) if size else 0) + max_tokens


def call_with_retries(
    call: Call,
    text: str,
    wait_out: bool,
    budget: Budget | None = None,
    max_retries: int = MAX_RETRIES,
    retry_step: float = RETRY_STEP_SECONDS,
    sleep: Callable[[float], None] = time.sleep,
    max_tokens: int = MAX_COMPLETION_TOKENS,
) -> tuple[str, str, str | None, int]:
    """(translation, status, error, attempts) of one row; a failure stays with its row."""
    attempt = 0
    calls = 0
    while True:
        if budget is not None:
            budget.spend(request_tokens(text, max_tokens))
        calls += 1
        try:
            return call(text) or "", "ok", None, calls
        except Exception as exc:
            message, limited = str(exc), rate_limited(exc)
        if wait_out and limited:
            sleep(wait_from_message(message))
        elif attempt < max_retries:
            sleep(retry_step * (attempt + 1))
            attempt += 1
        else:
            return "", "error", message, calls


class _Lane:
    """One backend inside one task: its connection and its budget."""

    def __init__(self, backend: Backend, limits: Limits | None, options: dict):
        self.name, self.in_flight = backend.name, backend.max_in_flight
        self.call, self.wait_out = backend.connect(), backend.waits_out_rate_limits
        self.options = {"max_tokens": backend.max_tokens, **options}
        self.budget = Budget(limits) if limits else None

    def run(self, text: str) -> tuple:
        return call_with_retries(self.call, text, self.wait_out, self.budget, **self.options)


BLANK_RESULT = ("", "blank", None, 0, None)


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Batches in parts of PART_ROWS rows, so that what a task holds of its results is small however many rows a batch has."""
    for batch in batches:
        for first in range(0, len(batch), PART_ROWS):
            yield batch.iloc[first : first + PART_ROWS]


def _enrich_batches(
    batches: Iterator[pd.DataFrame],
    backends: dict[str, Backend],
    limits: dict[str, Limits],
    options: dict,
    text: str,
    columns: list[str],
) -> Iterator[pd.DataFrame]:
    """Results part by part, in order; the next part is called while this one finishes.

    The threads of all backends take rows from one queue, so whichever has room
    takes the next row and a slow backend holds up no more rows than it has open.
    """
    with ExitStack() as cleanup:
        rows: SimpleQueue = SimpleQueue()
        lanes: list[_Lane] = []

        def work(lane: _Lane) -> None:
            while (item := rows.get()) is not None:
                value, future = item
                try:
                    future.set_result((*lane.run(value), lane.name))
                except BaseException as exc:
                    future.set_exception(exc)

        def start_lanes() -> None:
            lanes.extend(_Lane(b, limits.get(b.name), options) for b in backends.values())
            workers = [lane for lane in lanes for _ in range(max(1, lane.in_flight))]
            pool = cleanup.enter_context(ThreadPoolExecutor(len(workers)))
            for lane in workers:
                pool.submit(work, lane)
            cleanup.callback(lambda: [rows.put(None) for _ in workers])

        def start(value: str | None) -> Future | tuple:
            if not value:
                return BLANK_RESULT
            if not lanes:
                start_lanes()
            future: Future = Future()
            rows.put((value, future))
            return future

        def finish(batch: pd.DataFrame, started: list) -> pd.DataFrame:
            done = [item.result() if isinstance(item, Future) else item for item in started]
            result = pd.DataFrame(done, columns=[TARGET_COLUMN, "status", "error", "attempts", "backend"])
            result.index = batch.index
            return pd.concat([batch, result], axis=1)[columns]

        waiting: deque = deque()
        for batch in _parts(batches):
            waiting.append((batch, [start(value) for value in batch[text]]))
            if len(waiting) > 1:
                yield finish(*waiting.popleft())
        while waiting:
            yield finish(*waiting.popleft())


def _enrich(
    df: DataFrame,
    backends: dict[str, Backend],
    key: str,
    text: str,
    limits: dict[str, Limits] | None = None,
    on_error: str = "blank",
    profile: ResourceProfile | None = None,
    **options,
) -> DataFrame:
    if df.sparkSession.sparkContext.getConf().get("spark.speculation", "false") == "true":
        warnings.warn("speculative tasks call the model twice; set spark.speculation=false", stacklevel=3)
    source = df.select(key, F.coalesce(F.col(text), F.lit("")).alias(SOURCE_COLUMN))
    several = len(backends) > 1
    schema = ", ".join(f"`{name}` {kind}" for name, kind in source.dtypes) + ", " + RESULT + ", backend string" * several
    columns = [*source.columns, TARGET_COLUMN, "status", "error", "attempts", *["backend"] * several]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return _enrich_batches(batches, backends, limits or {}, options, SOURCE_COLUMN, columns)

    called = source.mapInPandas(run, schema, barrier=bool(limits) and _waves_allowed(source), profile=profile)
    return route_error_rows(called, on_error)


def _waves_allowed(df: DataFrame) -> bool:
    """Whether tasks can be made to run all at once: not where executors come and go with the load."""
    return df.sparkSession.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false") != "true"


def calling_profile(cpus: int = 1, **resources: float) -> ResourceProfile:
    """Resources that each task of a calling stage takes: with c cores a machine it runs c / `cpus` of them, whatever
    the other stages do. Further resources by name, such as `gpu=0.25`. Local sessions have none."""
    wanted = TaskResourceRequests().cpus(cpus)
    for name, amount in resources.items():
        wanted = wanted.resource(name, amount)
    return ResourceProfileBuilder().require(wanted).build


def enrich_text(
    df: DataFrame,
    backend: Backend,
    key: str = "row_id",
    text: str = "text",
    tasks: int | None = None,
    **options,
) -> DataFrame:
    """Translate each row: `key, text_en, text_ja, status, error, attempts`.

    Blank texts are not sent. A row that still fails after its retries gets
    status `error` and the run goes on; `on_error="keep_source"` keeps its text.
    The stage is narrow: rows are neither moved nor gathered. At most
    `tasks * max_in_flight` calls are open at a time; `tasks` merges partitions
    to bound that, or deals rows out to more, before any call is made. A `profile` (of `calling_profile`)
    gives the calling stage task resources of its own.
    """
    source = _in_tasks(df, tasks) if tasks else df
    return _enrich(source, {backend.name: backend}, key, text, **options)


def hybrid_enrich(
    df: DataFrame,
    backends: list[Backend],
    key: str = "row_id",
    text: str = "text",
    limits: dict[str, Limits] | None = None,
    tasks: int | None = None,
    **options,
) -> DataFrame:
    """Translate over several backends in one pass; column `backend` tells which one took a row (null for blanks).

    In each task the backend with room takes the next row. `limits` names the
    backends that have a rate budget; the tasks are then as many as it can be split over.
    """
    by_name = {backend.name: backend for backend in backends}
    dealt, shares = _deal(df, by_name, limits or {}, text, tasks)
    return _enrich(dealt, by_name, key, text, limits=shares, **options)


def budget_slots(
    spark: SparkSession, limits: Limits, wanted: int | None = None, largest: int = sized_request(1)
) -> int:
    """Tasks a budget is split over, at most `wanted`.

    All of them must run at once, and a share must admit the `largest` request,
    or it would be booked for less than it uses, on a large cluster only.
    """
    most = min(spark.sparkContext.defaultParallelism, limits.rpm, limits.tpm // largest)
    return max(1, min(wanted or most, most))


def _deal(
    df: DataFrame, backends: dict[str, Backend], limits: dict[str, Limits], text: str, tasks: int | None
) -> tuple[DataFrame, dict[str, Limits]]:
    """Rows dealt out evenly over the tasks of a budget, and each task's share of it.

    They are dealt in turn, whatever their keys, so no task sits on an unused
    share. The longest text is looked up first: the pass costs nothing beside
    the calls.
    """
    if not limits:
        return (_in_tasks(df, tasks) if tasks else df), {}
    # A request larger than the whole budget is booked as all of it: one task then, and one a minute.
    size = df.agg(F.coalesce(F.max(F.octet_length(text)), F.lit(0))).first()[0]
    slots = min(
        budget_slots(df.sparkSession, limit, tasks, sized_request(size, backends[name].max_tokens))
        for name, limit in limits.items()
    )
    return df.repartition(slots), {name: limit.split(slots) for name, limit in limits.items()}


def _in_tasks(df: DataFrame, tasks: int) -> DataFrame:
    """Merged into fewer partitions, or dealt out to more."""
    return df.coalesce(tasks) if tasks <= df.rdd.getNumPartitions() else df.repartition(tasks)


def rate_budgeted_enrich(
    df: DataFrame,
    backend: Backend,
    limits: Limits,
    key: str = "row_id",
    text: str = "text",
    tasks: int | None = None,
    **options,
) -> DataFrame:
    """Translate within requests and tokens per minute.

    The budget is split evenly over tasks that run in one wave: a barrier stage starts all of them or, with fewer
    slots than that, fails at once (so take no `limit` of the result before it is stored). A rerun starts with empty windows and
    relies on the retry of rate-limit errors.
    """
    by_name = {backend.name: backend}
    dealt, shares = _deal(df, by_name, {backend.name: limits}, text, tasks)
    return _enrich(dealt, by_name, key, text, limits=shares, **options)


def enrich_to_table(enriched: DataFrame, path: str, mode: str = "append") -> DataFrame:
    """Run an enrichment once, store it, and return the stored rows."""
    enriched.write.mode(mode).option("compression", "zstd").parquet(path)
    return enriched.sparkSession.read.schema(enriched.schema).parquet(path)


def enrich_report(stored: DataFrame) -> DataFrame:
    """Rows by status of a stored enrichment."""
    return stored.groupBy("status").agg(F.count(F.lit(1)).alias("rows"))
