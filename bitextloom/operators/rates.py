"""Rate planning and rate audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitextloom.defaults import RATE_TIERS, RATE_WINDOW_SECONDS
from bitextloom.functions.numbers import epoch_micros, int_div
from bitextloom.functions.rates import Limits
from bitextloom.functions.tokens import estimate_request_tokens

MICROS = RATE_WINDOW_SECONDS * 1_000_000


def request_totals(df: DataFrame, text: str = "text") -> DataFrame:
    """One row: requests the non-blank texts need, and their estimated tokens."""
    blank = F.coalesce(F.col(text), F.lit("")) == ""
    tokens = F.when(~blank, estimate_request_tokens(F.col(text)))
    return df.agg(F.count(tokens).alias("requests"), F.coalesce(F.sum(tokens), F.lit(0)).alias("tokens"))


def tier_plan(totals: DataFrame) -> DataFrame:
    """Per tier: admissible requests a minute at the mean request size, and the least minutes.

    The five tiers are exploded from a literal, so the one-row total is not joined.
    """
    tier = F.explode(
        F.array(
            *(
                F.struct(
                    F.lit(name).alias("tier"),
                    F.lit(rpm).cast("bigint").alias("rpm"),
                    F.lit(tpm).cast("bigint").alias("tpm"),
                )
                for name, rpm, tpm in RATE_TIERS
            )
        )
    )
    plan = totals.select("requests", "tokens", tier.alias("t")).select("requests", "tokens", "t.*")
    # A request larger than the limit is booked at the limit: one a minute always passes.
    by_tokens = F.floor(F.col("tpm") / (F.col("tokens") / F.col("requests")))
    rate = F.greatest(F.lit(1).cast("bigint"), F.least(F.col("rpm"), by_tokens))
    rate = F.when(F.col("requests") == 0, F.col("rpm")).otherwise(rate)
    sized = plan.withColumn("requests_per_minute", rate)
    minutes = F.round(F.col("requests") / F.col("requests_per_minute"), 6).alias("min_minutes")
    return sized.select("tier", "requests", "tokens", "requests_per_minute", minutes)


def rate_window_usage(
    log: DataFrame, limits: Limits, time: str = "ts", backend: str = "backend", tokens: str = "tokens"
) -> DataFrame:
    """Add to each request the requests and tokens of its backend in the last 60 seconds.

    An entry of age 60 s has expired: the window is (t-60s, t]. Added columns:
    `requests_60s`, `tokens_60s`, `over_budget`.

    Rows without a backend form one of their own; without a time, usage is null.

    A sliding window per backend would sort a whole backend in one task and
    re-add its frame at every row. Instead the log is first summed per
    (backend, instant); then time is cut into minutes, and inside a minute a
    running sum adds entries and takes expiries off again. Entries of one
    minute expire in the next, so each is also carried once into the next
    minute. A group is one backend's minute: at most 60 million instants,
    whatever the number of rows.
    """
    micros = epoch_micros(F.col(time), dict(log.dtypes)[time])
    size = F.greatest(F.lit(1).cast("bigint"), F.least(F.col(tokens).cast("bigint"), F.lit(limits.tpm)))
    rows = log.withColumns({"_at": micros, "_tokens": size})
    instants = rows.where("_at IS NOT NULL").groupBy(backend, "_at").agg(
        F.count(F.lit(1)).alias("n"), F.sum("_tokens").alias("tok")
    )
    minute = int_div(F.col("_at") - F.pmod(F.col("_at"), F.lit(MICROS)), MICROS)
    next_start = (minute + 1) * MICROS

    def delta(in_minute: Column, at: Column, sign: int, entry: bool) -> Column:
        return F.struct(
            in_minute.alias("minute"),
            at.alias("at"),
            (F.col("n") * sign).alias("n"),
            (F.col("tok") * sign).alias("tok"),
            F.lit(entry).alias("entry"),
        )

    deltas = instants.select(
        backend,
        F.explode(
            F.array(
                delta(minute, F.col("_at"), 1, True),
                delta(minute + 1, next_start, 1, False),
                delta(minute + 1, F.col("_at") + MICROS, -1, False),
            )
        ).alias("d"),
    ).select(backend, "d.*")
    running = Window.partitionBy(backend, "minute").orderBy("at").rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    usage = (
        deltas.withColumns({"requests_60s": F.sum("n").over(running), "tokens_60s": F.sum("tok").over(running)})
        .where("entry")
        .select(F.col(backend).alias("_backend"), F.col("at").alias("_instant"), "requests_60s", "tokens_60s")
    )
    same = F.col(backend).eqNullSafe(F.col("_backend")) & (F.col("_at") == F.col("_instant"))
    over = (F.col("requests_60s") > limits.rpm) | (F.col("tokens_60s") > limits.tpm)
    audited = rows.join(usage, same, "left").withColumn("over_budget", over)
    return audited.drop("_at", "_tokens", "_backend", "_instant")


def round_robin_assign(
    df: DataFrame, weights: dict[str, int], ordinal: str = "ordinal", name: str = "backend"
) -> DataFrame:
    """Give each row a backend in turn, each backend as often as its weight; keys that are no integers by their hash."""
    total = sum(weights.values())
    whole = dict(df.dtypes)[ordinal] in ("tinyint", "smallint", "int", "bigint")
    place = F.pmod(F.col(ordinal) if whole else F.xxhash64(ordinal), F.lit(total))
    chosen, upper = None, 0
    for backend, weight in weights.items():
        upper += weight
        chosen = F.when(place < upper, backend) if chosen is None else chosen.when(place < upper, backend)
    return df.withColumn(name, chosen)


def endpoint_of(ordinal: Column, urls: list[str]) -> Column:
    """The base URL that serves the n-th worker: URLs in turn."""
    return F.element_at(F.array(*map(F.lit, urls)), (F.pmod(ordinal, F.lit(len(urls))) + 1).cast("int"))
