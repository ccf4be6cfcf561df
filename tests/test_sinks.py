import os

import pytest
from pyspark.sql import functions as F

from bitextloom.functions import shard_number
from bitextloom.operators import existing_rows, next_shard_number
from bitextloom.sinks import (
    format_filter_report,
    format_profile_report,
    number_shards,
    parse_size,
    reshard_for_publish,
    shard_manifest,
    write_by_rows,
    write_by_size,
    write_ordered,
)
from bitextloom.sources import global_ordinal


def shard_rows(spark, path):
    return [r["rows"] for r in shard_manifest(spark, path, "s").orderBy("shard_id").collect()]


def test_exact_row_shards_in_order(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("bitextloom.sinks.parquet.MIN_TASK_ROWS", 100)
    out = str(tmp_path / "out")
    df = spark.range(0, 1050).select((F.lit(1049) - F.col("id")).alias("ordinal"))
    write_by_rows(df, out, 100, "ordinal", 1050)
    assert shard_rows(spark, out) == [100] * 10 + [50]
    read = spark.read.parquet(out).withColumnRenamed("ordinal", "value")
    assert global_ordinal(read).where("value <> ordinal").count() == 0


def test_row_cap_without_ordinal(spark, tmp_path):
    out = str(tmp_path / "out")
    write_by_rows(spark.range(250).coalesce(1), out, 100)
    assert sorted(shard_rows(spark, out)) == [50, 100, 100]


def test_no_rows_make_no_shard(spark, tmp_path):
    out = str(tmp_path / "out")
    write_by_rows(spark.range(0), out, 100)
    assert shard_rows(spark, out) == []


def test_rebalanced_sizes_split_a_dominant_input(spark, tmp_path):
    """One input partition holds everything; output files still have about the wanted size."""
    out = str(tmp_path / "out")
    df = spark.range(60_000).select(F.concat_ws("-", *(F.xxhash64("id", F.lit(i)) for i in range(6))).alias("text")).coalesce(1)
    wide = df.union(df.limit(0))
    write_by_size(wide, out, max_mb=1, stored_ratio=0.7)
    sizes = [r["bytes"] for r in shard_manifest(spark, out, "s").collect()]
    assert spark.read.parquet(out).count() == 60_000
    assert len(sizes) > 2 and max(sizes) < 2.5 * 2**20
    assert all(name.endswith(".zstd.parquet") for name in os.listdir(out) if name.endswith(".parquet"))


def test_size_by_input_splits_does_not_shuffle(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    spark.range(1000).repartition(8).write.parquet(source)
    write_by_size(spark.read.parquet(source).where("id % 2 = 0"), out, max_mb=1, shuffle=False)
    assert spark.read.parquet(out).count() == 500


def test_manifest_continues_numbering(spark, tmp_path):
    out = str(tmp_path / "out")
    write_by_rows(spark.range(20).coalesce(1), out, 10)
    rows = shard_manifest(spark, out, "corpus", 5).orderBy("shard_id").collect()
    assert [(r["shard_id"], r["shard"], r["rows"]) for r in rows] == [
        (5, "corpus-00005.parquet", 10),
        (6, "corpus-00006.parquet", 10),
    ]


def test_numbered_names_go_on_after_the_highest(spark, tmp_path):
    out = str(tmp_path / "out")
    ordered = spark.range(60).select(F.col("id").alias("ordinal"))
    write_by_rows(ordered, out, 20, "ordinal", 60)
    assert number_shards(spark, out, "c") == 3
    write_by_rows(ordered.where("ordinal < 20"), out, 20, "ordinal", 20)
    assert number_shards(spark, out, "c") == 4 == next_shard_number(spark, out, "c")
    assert sorted(n for n in os.listdir(out) if n.endswith(".parquet")) == [f"c-0000{i}.parquet" for i in range(4)]
    values = [r["ordinal"] for r in global_ordinal(spark.read.parquet(out), "place").orderBy("place").collect()]
    assert values == [*range(60), *range(20)]
    assert existing_rows(spark, out, "c").agg(F.sum("rows")).first()[0] == 80


def test_existing_shards(spark, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    out = str(tmp_path)
    assert next_shard_number(spark, f"{out}/none", "c") == 0 and existing_rows(spark, f"{out}/none").count() == 0
    for name, rows in (("c-00003.parquet", 3), ("c-00011.parquet", 4), ("c-x.parquet", 5), ("d-00050.parquet", 6)):
        pq.write_table(pa.table({"v": list(range(rows))}), tmp_path / name)
    (tmp_path / "c-00012.parquet").write_bytes(b"broken")
    assert next_shard_number(spark, out, "c") == 13
    assert existing_rows(spark, out, "c").agg(F.sum("rows")).first()[0] == 12
    with pytest.raises(Exception, match="unreadable shard"):
        existing_rows(spark, out, "c", on_unreadable="fail").collect()
    assert spark.range(1).select(shard_number(F.lit("c-00011.parquet"), "c")).first()[0] == 11


def test_reshard_keeps_order_and_size(spark, tmp_path):
    """Files with very different row sizes."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    text = F.concat_ws("-", *(F.xxhash64("id", F.lit(i)) for i in range(12)))
    df = spark.range(8000).select(F.col("id"), F.when(F.col("id") < 2000, text).otherwise("x").alias("text"))
    write_ordered(df.withColumn("ordinal", F.col("id")), source, total_rows=8000, files=4)
    manifest = reshard_for_publish(spark, source, out, "train", "100KB")
    assert manifest.agg(F.max("bytes")).first()[0] <= 100_000
    assert manifest.agg(F.sum("rows")).first()[0] == 8000 and manifest.count() > 3
    read = spark.read.parquet(f"{out}/train").drop("ordinal")
    assert global_ordinal(read).where("id <> ordinal").count() == 0
    with pytest.raises(FileNotFoundError):
        reshard_for_publish(spark, str(tmp_path / "empty"), out)


def test_sizes():
    assert [parse_size(s) for s in ("1GB", "500 MB", "2GiB", "7", 9)] == [10**9, 5 * 10**8, 2**31, 7, 9]
    with pytest.raises(ValueError):
        parse_size("big")


def test_report_layout():
    counters = {"processed": 4, "skipped": 1, "skipped_special": 1, "kept": 2}
    assert format_filter_report(counters) == "processed: 4\nskipped: 1\nskipped_special: 1\nkept: 2"
    summary = dict(samples=2, missing_text=0, empty_text=1, skipped_special=0, min_tokens=0, max_tokens=7,
                   mean_tokens=3.5, p50=3.5, p90=6.3, p95=6.65, p99=6.93)
    bars = [dict(bucket_start=0, bucket_end=199, cnt=2, pct=100.0)]
    assert format_profile_report(summary, bars).split("\n") == [
        "samples: 2",
        "missing_text: 0",
        "empty_text: 1",
        "skipped_special: 0",
        "min: 0 max: 7 mean: 3.50",
        "p50: 3.5 p90: 6.3 p95: 6.7 p99: 6.9",
        "histogram:",
        "     0-199         2 (100.0%)",
    ]


def hashed(count, low=0):
    return F.concat_ws("-", *(F.xxhash64("id", F.lit(i)) for i in range(low, count)))


SIZED = {
    "incompressible": lambda spark: spark.range(30_000).select("id", hashed(6).alias("text")),
    "one run of each": lambda spark: spark.range(30_000).coalesce(1).select(
        "id", F.when(F.col("id") < 15_000, F.repeat(F.lit("same words "), 40)).otherwise(hashed(12)).alias("text")
    ),
    "few long texts": lambda spark: spark.range(400).select(
        "id", F.when(F.col("id") % 40 == 7, F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(4000)), lambda i: F.xxhash64("id", i)))).otherwise("x").alias("text")
    ),
    "nested": lambda spark: spark.range(20_000).select("id", F.array(hashed(3), hashed(6, 3)).alias("parts"), (F.col("id") % 2 == 0).alias("even")),
}


@pytest.mark.parametrize("kind", SIZED)
@pytest.mark.parametrize("shuffle", [True, False])
def test_no_file_is_over_the_limit(spark, tmp_path, kind, shuffle):
    out, df = str(tmp_path / "out"), SIZED[kind](spark)
    write_by_size(df, out, max_mb=0.125, shuffle=shuffle)
    files = shard_manifest(spark, out, "s").collect()
    assert max(r["bytes"] for r in files) <= 2**17 and len(files) > 2
    assert spark.read.parquet(out).exceptAll(df).count() == 0 == df.exceptAll(spark.read.parquet(out)).count()
    if shuffle and kind != "few long texts":
        assert sum(r["bytes"] for r in files) / len(files) > 2**17 / 3, "shards are not crumbs"


def test_rows_over_the_limit_stay_alone_and_order_holds(spark, tmp_path):
    out = str(tmp_path / "out")
    df = spark.range(60).coalesce(1).select("id", F.when(F.col("id") % 20 == 3, hashed(400)).otherwise("y").alias("text"))
    write_by_size(df, out, max_mb=4000 / 2**20)
    sizes = {r["rows"]: r["bytes"] for r in shard_manifest(spark, out, "s").orderBy("bytes").collect()}
    assert all(rows == 1 or size <= 4000 for rows, size in sizes.items())
    assert global_ordinal(spark.read.parquet(out)).where("id <> ordinal").count() == 0
    write_by_size(spark.range(0).selectExpr("id", "'' as text"), str(tmp_path / "none"), max_mb=1)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_publishing_rewrites_only_what_is_over(spark, tmp_path):
    """The long rows stand at the end of a file: its shards are cut by rows, so only the last ones are over."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.range(4000).coalesce(1).select("id", F.when(F.col("id") >= 3900, hashed(60)).otherwise(hashed(1)).alias("text"))
    write_ordered(df.withColumn("ordinal", F.col("id")), source, total_rows=4000, files=1)
    manifest = reshard_for_publish(spark, source, out, "train", 40_000)
    rows = manifest.collect()
    assert max(r["bytes"] for r in rows) <= 40_000 and sum(r["rows"] for r in rows) == 4000
    names = [os.path.basename(r["path"]) for r in rows]
    assert any(".s0000" in name for name in names) and any(".s0000" not in name for name in names)
    assert global_ordinal(spark.read.parquet(f"{out}/train").drop("ordinal")).where("id <> ordinal").count() == 0
