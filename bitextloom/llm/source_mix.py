"""Mixing sources to target weights by weighted sampling without replacement; DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bitextloom.llm.tables import broadcast_if_small, stored

WORD = r"[^\x20\x09-\x0D]+"
# No document is taken more often, so no source's target is above so many times its size.
MAX_EPOCHS = 3
# The keys of a source fall into so many ranges, and the range in which its budget ends again; only what is
# left then, one part in RANGES ** LEVELS, is put in exact order.
RANGES = 256
LEVELS = 2
SEED = "mix"


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text).cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def sampling_key(quality: Column, seed: str = SEED) -> Column:
    """Efraimidis-Spirakis: an exponential key divided by the weight; the smallest keys are taken first.

    The uniform number comes from 52 bits of a digest of doc_id, so reruns and lost tasks agree.
    """
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))), 1, 13), 16, 10)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(2**52))) / quality


def with_key(rows: DataFrame, quality: Column, seed: str = SEED) -> DataFrame:
    """`rows` with mix_key and mix_id. A quality that is null or not above 0 counts as 1."""
    weight = F.coalesce(F.when(quality > 0, quality.cast("double")), F.lit(1.0))
    return rows.withColumns({"mix_key": sampling_key(weight, seed), "mix_id": F.coalesce(F.col("doc_id"), F.lit(-(2**63)))})


def sized(docs: DataFrame, quality: DataFrame | None, seed: str = SEED) -> DataFrame:
    """doc_id, source, mix_size, mix_key, mix_id: the one reading of the texts. `quality` (doc_id, quality) has one row a document."""
    sizes = docs.select("doc_id", "source", word_count().alias("mix_size"))
    if quality is not None:
        # Texts are out of the rows by now: only ids and numbers meet the qualities.
        sizes = stored(sizes, "counted").join(quality.select("doc_id", F.col("quality").alias("mix_quality")), "doc_id", "left")
    else:
        sizes = sizes.withColumn("mix_quality", F.lit(1.0))
    return stored(with_key(sizes, F.col("mix_quality"), seed).drop("mix_quality"), "sizes")


def source_targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size, target, epochs, budget: one row per source.

    Weights 1, 2, 3 repeat over the sources in code point order, null last. Sources whose share would be above
    the cap are capped in the order of cap by weight; the water level of the others is the largest level met on the way.
    """
    sources = sizes.groupBy("source").agg(F.sum("mix_size").alias("source_size"))
    by_name, by_ratio = Window.orderBy(F.col("source").asc_nulls_last()), Window.orderBy("ratio", "place")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    ranked = (
        sources.withColumn("place", F.row_number().over(by_name))
        .withColumn("weight", ((F.col("place") - 1) % 3 + 1).cast("double"))
        .withColumn("cap", (max_epochs * F.col("source_size")).cast("double"))
        .withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    left_size = F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = ranked.withColumn("level", left_size / left_weight)
    target = F.least("cap", F.col("weight") * F.max("level").over(everything))
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(F.col("target") / F.col("source_size")), F.lit(max_epochs)))
    return (
        level.withColumn("target", F.greatest(target, F.lit(0.0)))
        .withColumn("epochs", F.coalesce(epochs, F.lit(0)).cast("long"))
        .withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
        .select("source", "source_size", "target", "epochs", "budget")
    )


def mix_plan(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """`source_targets` plus cut_key and cut_id, the last document that the part of an epoch takes.

    Keys fall into ranges that keep their order. Sizes are summed by range, the range in which the budget ends
    is found from running sums of at most RANGES rows a source, and only its documents are sorted. The
    document at the end is taken whole if that comes nearer to the budget.
    """
    targets = stored(source_targets(sizes, max_epochs), "targets")
    ends = targets.filter("budget > 0").select(F.col("source").alias("of"), "budget", F.lit(0.0).alias("before"))
    rows, total = sizes, 1
    for _ in range(LEVELS):
        total *= RANGES
        bucket = F.least(F.floor((1 - F.exp(-F.col("mix_key"))) * total), F.lit(total - 1))
        placed = rows.withColumn("bucket", bucket)
        summed = placed.groupBy("source", "bucket").agg(F.sum("mix_size").alias("n"))
        running = Window.partitionBy("source").orderBy("bucket")
        upto = F.col("before") + F.sum("n").over(running)
        found = (
            summed.join(broadcast_if_small(ends), F.col("source").eqNullSafe(F.col("of")))
            .withColumn("upto", upto)
            .filter("upto >= budget and upto - n < budget")
        )
        ends = stored(found.select("of", "budget", (F.col("upto") - F.col("n")).alias("before"), F.col("bucket").alias("at")), "ends")
        inside = placed.join(
            broadcast_if_small(ends.select("of", "at")), F.col("source").eqNullSafe(F.col("of")) & (F.col("bucket") == F.col("at"))
        )
        rows = inside.select("source", "mix_size", "mix_key", "mix_id")
    crossing = broadcast_if_small(ends)
    inside = rows.join(crossing, F.col("source").eqNullSafe(F.col("of")))
    units = inside.groupBy("of", "before", "budget", "mix_key", "mix_id").agg(F.sum("mix_size").alias("n"))
    order = Window.partitionBy("of").orderBy("mix_key", "mix_id")
    taken = (
        units.withColumn("upto", F.col("before") + F.sum("n").over(order))
        .filter("upto - n / 2 <= budget")
        .groupBy("of")
        .agg(F.max(F.struct("mix_key", "mix_id")).alias("cut"))
    )
    # Where no document of the range is taken, the cut lies at the range's lower edge.
    edge = -F.log(1 - F.col("at") / F.lit(float(total)))
    cuts = crossing.select("of", "at").join(taken.withColumnRenamed("of", "end_of"), F.col("of").eqNullSafe(F.col("end_of")), "left")
    cuts = cuts.select(
        "of",
        F.coalesce("cut.mix_key", edge).alias("cut_key"),
        F.coalesce("cut.mix_id", F.lit(-(2**63))).alias("cut_id"),
    )
    return stored(
        targets.join(cuts, F.col("source").eqNullSafe(F.col("of")), "left").select(
            F.col("source").alias("of"), "source_size", "target", "epochs", "cut_key", "cut_id"
        ),
        "mix-plan",
    )


def with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """`rows` of `keyed` with source_size, target and copies: complete epochs, plus one up to the cut."""
    inside = (F.col("mix_key") < F.col("cut_key")) | ((F.col("mix_key") == F.col("cut_key")) & (F.col("mix_id") <= F.col("cut_id")))
    joined = rows.join(broadcast_if_small(plan), F.col("source").eqNullSafe(F.col("of")), "left")
    return joined.withColumn("copies", F.col("epochs") + F.coalesce(inside, F.lit(False)).cast("long"))


def mix_sources(docs: DataFrame, quality: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """One row per row of `docs`: doc_id, source, size, source_size, target, copies, taken (size * copies).

    `quality` (doc_id, quality) weighs the draw; documents without one have 1. Null and empty texts have size 0.
    Rows repeated with one doc_id are taken together. An empty table gives none. Texts are read once, for their
    sizes, and never shuffled.
    """
    sizes = sized(docs, quality, seed)
    return with_copies(sizes, mix_plan(sizes, max_epochs)).select(
        "doc_id", "source", F.col("mix_size").alias("size"), "source_size", "target", "copies",
        (F.col("mix_size") * F.col("copies")).alias("taken"),
    )


def take_mix(docs: DataFrame, quality: DataFrame | None = None, max_epochs: int = MAX_EPOCHS, seed: str = SEED) -> DataFrame:
    """The mixed corpus: each row of `docs` as often as `mix_sources` says, columns unchanged.

    Qualities meet ids and keys alone. The rows are repeated by their keys of weight 1; ids that are taken otherwise because
    of their quality are listed, and broadcast if they are few.
    """
    sizes = sized(docs, quality, seed)
    plan = mix_plan(sizes, max_epochs)
    inner = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("mix_row"), "doc_id", "source")
    # The key needs no text, and the plan is one row a source: the second reading only repeats rows.
    repeated = with_copies(with_key(inner, F.lit(1.0), seed), plan)
    if quality is not None:
        weighed = with_copies(sizes, plan).select("doc_id", "source", F.col("copies").alias("mix_copies"))
        plain = with_copies(with_key(weighed, F.lit(1.0), seed), plan).filter("copies <> mix_copies")
        other = plain.select(F.col("doc_id").alias("mix_of"), F.col("source").alias("mix_from"), "mix_copies").distinct()
        same = (F.col("doc_id") == F.col("mix_of")) & F.col("source").eqNullSafe(F.col("mix_from"))
        repeated = repeated.join(broadcast_if_small(stored(other, "mix-weighed")), same, "left")
        repeated = repeated.withColumn("copies", F.coalesce("mix_copies", "copies"))
    return repeated.select("mix_row", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int")))).select("mix_row.*")
