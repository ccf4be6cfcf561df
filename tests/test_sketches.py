"""Merged sketches stand for the whole within their bound."""

from pyspark.sql import functions as F

from bitextloom.operators import rank_error, sketch_percentiles, store_sketches, stored_sketches, token_sketches

PERCENTS = (1, 10, 50, 90, 99)


def numbers(spark, rows):
    """Texts of 3 x n bytes for skewed n, which are n tokens."""
    n = F.floor(1 + 400 * F.pow(F.pmod(F.xxhash64("id"), F.lit(10_000)) / 10_000, F.lit(3)))
    return spark.range(rows).select("id", F.repeat(F.lit("abc"), n.cast("int")).alias("text"), n.cast("long").alias("n"))


def off(rows, found):
    """Shares by which the rank of each percentile is off."""
    values, result = sorted(rows), []
    for p in PERCENTS:
        low = sum(v < found[f"p{p}"] for v in values) / len(values)
        high = sum(v <= found[f"p{p}"] for v in values) / len(values)
        result.append(max(0.0, low - p / 100, p / 100 - high))
    return result


def test_rank_error_of_merged_sketches(spark, tmp_path):
    path, k = str(tmp_path / "sketches"), 200
    docs = numbers(spark, 60_000).cache()
    day = F.concat(F.lit("day"), F.col("id") % 9)
    store_sketches(token_sketches(docs.where("id % 9 < 5"), day, k=k), path)
    store_sketches(token_sketches(docs.where("id % 9 >= 5"), day, k=k), path)
    stored = stored_sketches(spark, path)
    assert stored.count() == 9 and stored.agg(F.sum("samples")).first()[0] == 60_000
    values = [r["n"] for r in docs.select("n").collect()]
    merged = sketch_percentiles(stored, percents=PERCENTS, k=k).first()
    whole = sketch_percentiles(token_sketches(docs, F.lit("all"), k=k), percents=PERCENTS, k=k).first()
    assert (merged["min_tokens"], merged["max_tokens"]) == (min(values), max(values)) == (whole["min_tokens"], whole["max_tokens"])
    assert max(off(values, merged)) <= rank_error(k) and max(off(values, whole)) <= rank_error(k)
    assert stored.agg(F.max(F.octet_length("sketch"))).first()[0] < 10_000


def test_parts_groups_and_nothing(spark, tmp_path, texts):
    path = str(tmp_path / "sketches")
    assert stored_sketches(spark, path).count() == 0
    none = sketch_percentiles(stored_sketches(spark, path)).first()
    assert none["samples"] == 0 and none["p50"] is None
    docs = texts(None, "", "abcdef", "<|end|>", "x" * 30)
    store_sketches(token_sketches(docs, F.lit("a")), path)
    store_sketches(token_sketches(texts("abc"), F.lit("a")), path)
    store_sketches(token_sketches(texts("x" * 300, "y" * 600), F.lit("b")), path)
    rows = {r["part"]: r for r in sketch_percentiles(stored_sketches(spark, path), ("part",)).collect()}
    assert (rows["a"]["samples"], rows["a"]["p50"], rows["b"]["samples"], rows["b"]["max_tokens"]) == (1, 1, 2, 200)
    first = sketch_percentiles(token_sketches(docs, F.lit("a"))).first()
    assert (first["samples"], first["min_tokens"], first["max_tokens"], first["p90"]) == (5, 0, 10, 10)
