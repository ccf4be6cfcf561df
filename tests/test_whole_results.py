"""Cases in which caps, prefixes or sizes once changed a result."""

import io
import re
from contextlib import redirect_stdout

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from bitextloom.functions import Tokenizer, byte_tokenizer
from bitextloom.functions.text import special_token_pattern
from bitextloom.operators import filter_max_tokens, filter_report, first_rows_by_key, token_frequencies, token_histogram
from bitextloom.plans import filter_corpus, profile_corpus
from bitextloom.session import scoped_conf
from bitextloom.sinks import shard_manifest
from bitextloom.sources import global_ordinal, scan_corpus, scan_from_offset, take_first_rows
from bitextloom.streaming import incremental_filter, live_progress, read_new_files


def test_progress_counts_more_batches_than_spark_keeps(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(8):
        pq.write_table(pa.table({"text": [f"t{i}"]}), tmp_path / "in" / f"{i}.parquet")
    progress = str(tmp_path / "progress")
    with scoped_conf(spark, spark__sql__streaming__numRecentProgressUpdates="3"):
        stream = read_new_files(spark, str(tmp_path / "in"), "text string", files_per_batch=1)
        incremental_filter(stream, str(tmp_path / "out"), str(tmp_path / "mark"), progress=progress).awaitTermination()
    assert live_progress(spark, progress).agg({"processed": "sum", "kept": "sum"}).first()[:] == (8, 8)


@pytest.mark.parametrize("text", ["a <|end|> b", "a long text of over thirty bytes <|end|> b"])
def test_special_texts_are_refused_at_any_length(texts, text):
    df, tokenizer = texts(text, "plain"), byte_tokenizer()
    assert [r["text"] for r in filter_max_tokens(df, 30, tokenizer=tokenizer).collect()] == ["plain"]
    report = filter_report(df, 30, tokenizer=tokenizer).first()
    assert (report["skipped_special"], report["kept"], report["over_limit"]) == (1, 1, 0)


def test_a_tokenizer_without_special_names_refuses_nothing(texts):
    tokenizer = Tokenizer(name="bytes", merges=(), special_names=())
    assert filter_max_tokens(texts("abc", "a <|end|>"), 30, tokenizer=tokenizer).count() == 2
    assert re.search(special_token_pattern(()), "anything") is None
    with pytest.raises(ValueError):
        Tokenizer(rank_file="some.ranks")


def test_caps_keep_null_and_wide_keys(spark):
    rows = [(None, "n"), (5, "a"), (-(2**62) * 2 + 3, "low"), (2**63 - 9, "high"), (7, "b")]
    df = spark.createDataFrame(rows, "k bigint, text string")
    for cap, expected in ((1, ["low"]), (3, ["a", "b", "low"]), (4, ["a", "b", "high", "low"]), (5, ["a", "b", "high", "low", "n"]), (9, ["a", "b", "high", "low", "n"])):
        assert sorted(r["text"] for r in first_rows_by_key(df, "k", cap).collect()) == expected
    with pytest.raises(ValueError):
        first_rows_by_key(df.union(df.where("k IS NULL")), "k", 5)


def test_wide_keys_in_many_rows(spark):
    """Hashes as keys: further apart than a bigint holds, and too many to sort at once."""
    df = spark.range(120_000).selectExpr("xxhash64(id) AS k")
    expected = [r["k"] for r in df.orderBy("k").limit(60_001).collect()]
    assert sorted(r["k"] for r in first_rows_by_key(df, "k", 60_001).collect()) == expected


NAMES = ["a b+c", "a.b", "z%41", "あ", "é d"]


def test_files_are_ordered_by_their_names_not_by_escapes(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    order = sorted(NAMES)
    for place, name in enumerate(order):
        pq.write_table(pa.table({"n": list(range(place * 3, place * 3 + 3))}), folder / f"{name}.parquet")
        (folder / f"{name}.json").write_text("\n".join('{"text":"%d"}' % n for n in range(place * 3, place * 3 + 3)))
    df = spark.read.parquet(f"{folder}/*.parquet")
    assert global_ordinal(df).where("n <> ordinal").count() == 0
    for cap in range(16):
        assert sorted(r["n"] for r in take_first_rows(df, cap).collect()) == list(range(cap))
        assert sorted(r["n"] for r in scan_from_offset(df, cap).collect()) == list(range(cap, 15))
        lines = scan_corpus(spark, f"{folder}/*.json", cap=cap).collect()
        assert sorted(int(r["text"]) for r in lines) == list(range(cap))
    paths = [r["path"] for r in shard_manifest(spark, f"{folder}/*.parquet").orderBy("shard_id").collect()]
    assert [p.rsplit("/", 1)[1].removesuffix(".parquet") for p in paths] == order


def test_field_is_that_of_the_first_record_not_the_first_file(spark, tmp_path):
    for name, content in (("a", ""), ("b", "\n \n"), ("c", ""), ("d", '{"en_text":"x"}\n{"en_text":"y"}')):
        (tmp_path / f"{name}.json").write_text(content)
    assert sorted(r["text"] for r in scan_corpus(spark, f"{tmp_path}/*.json").collect()) == ["x", "y"]


def test_numbers_in_a_parquet_text_column_are_missing_texts(spark, tmp_path):
    spark.range(5).selectExpr("id AS text").write.parquet(str(tmp_path / "in"))
    summary = profile_corpus(spark, f"{tmp_path}/in/*.parquet", max_samples=10).summary.first()
    assert (summary["samples"], summary["missing_text"]) == (5, 5)
    assert filter_corpus(spark, f"{tmp_path}/in/*.parquet", str(tmp_path / "out"))["skipped"] == 5


def test_histogram_reads_its_texts_once(spark, tmp_path):
    spark.range(50).selectExpr("repeat('x', CAST(id * id * 40 AS INT)) AS text").write.parquet(str(tmp_path / "in"))
    df = token_histogram(token_frequencies(spark.read.parquet(str(tmp_path / "in"))), 10)
    plan = io.StringIO()
    with redirect_stdout(plan):
        df.explain()
    assert plan.getvalue().count("FileScan parquet") == 1
    rows = df.collect()
    assert [r["bucket_start"] for r in rows] == sorted(range(0, rows[-1]["bucket_end"], 10)) and sum(r["cnt"] for r in rows) == 50
    empty = token_histogram(token_frequencies(spark.read.parquet(str(tmp_path / "in")).limit(0)))
    assert [tuple(r) for r in empty.collect()] == [(0, 199, 0, 0.0)]
