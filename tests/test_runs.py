import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from bitextloom.functions import Limits
from bitextloom.operators import FaultyBackend, PrefixBackend, enrich_report
from bitextloom.plans import (
    TranslationSettings,
    filter_corpus,
    profile_corpus,
    translate_corpus,
    translate_pending,
    translation_progress,
    translation_status,
    translator,
)
from bitextloom.sources import StateLog, expand_paths, global_ordinal
from bitextloom.streaming import incremental_enrich, incremental_filter, live_progress, read_new_files


def add_file(folder, name, first, rows):
    folder.mkdir(exist_ok=True)
    ids = list(range(first, first + rows))
    texts = [None if i % 5 == 0 else f"text {i}" for i in ids]
    pq.write_table(pa.table({"row_id": ids, "text": pa.array(texts, pa.string())}), folder / name)


SCHEMA = "row_id bigint, text string"


def test_incremental_enrich_restarts_and_replays(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    state = StateLog(spark, str(tmp_path / "state"))

    def run(checkpoint):
        stream = read_new_files(spark, str(source), SCHEMA, files_per_batch=1)
        incremental_enrich(stream, PrefixBackend(), out, checkpoint, state=state).awaitTermination()
        return sorted(r["row_id"] for r in spark.read.parquet(out).collect())

    add_file(source, "a.parquet", 0, 10)
    add_file(source, "b.parquet", 10, 5)
    assert run(mark) == list(range(15))
    assert run(mark) == list(range(15))
    add_file(source, "c.parquet", 15, 3)
    assert run(mark) == list(range(18))
    assert state.latest()["written"] == 18
    # A lost checkpoint replays every batch into the folders it had before.
    assert run(str(tmp_path / "mark2")) == list(range(18))


def test_incremental_enrich_with_a_named_translator(spark, tmp_path):
    add_file(tmp_path / "in", "a.parquet", 0, 6)
    stream = read_new_files(spark, str(tmp_path / "in"), SCHEMA)
    translate = translator(PrefixBackend(), key="row_id", on_error="keep_source")
    out = str(tmp_path / "out")
    incremental_enrich(stream, translate, out, str(tmp_path / "mark")).awaitTermination()
    assert spark.read.parquet(out).where("text_ja = concat('[ja] ', text_en)").count() == 4


def test_incremental_filter_counts_while_it_runs(spark, tmp_path):
    source, out, mark = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "mark")
    add_file(source, "a.parquet", 0, 10)
    add_file(source, "b.parquet", 10, 10)
    counted = str(tmp_path / "counted")
    assert live_progress(spark, counted).count() == 0
    for expected in (2, 2):
        stream = read_new_files(spark, str(source), SCHEMA, files_per_batch=1)
        incremental_filter(stream, out, mark, max_tokens=3, keep=("row_id",), progress=counted).awaitTermination()
        assert live_progress(spark, counted).where("processed > 0").count() == expected
    kept = sorted(r["row_id"] for r in spark.read.parquet(out).collect())
    assert kept == [i for i in range(20) if i % 5]


def test_filter_corpus_on_json_lines(spark, tmp_path):
    lines = ['{"text":"ab"}', '{"text":null}', '{"text":"<|end|>"}', '{"text":""}', "not json", '{"text":"%s"}' % ("x" * 90)]
    (tmp_path / "in.json").write_text("\n".join(lines))
    out = str(tmp_path / "out")
    row = filter_corpus(spark, str(tmp_path / "in.json"), out, max_tokens=30)
    assert row.asDict() == {"processed": 6, "skipped": 2, "skipped_special": 1, "kept": 2, "over_limit": 1}
    assert sorted(r["en_text"] for r in spark.read.parquet(out).collect()) == ["", "ab"]
    capped = filter_corpus(spark, str(tmp_path / "in.json"), str(tmp_path / "capped"), max_tokens=30, max_samples=3)
    assert (capped["processed"], capped["kept"]) == (3, 1)


def test_profile_report(spark, tmp_path):
    (tmp_path / "in.json").write_text("\n".join(['{"text":"%s"}' % ("x" * n) for n in (0, 3, 30, 300)] * 2))
    report = profile_corpus(spark, str(tmp_path / "in.json"), max_samples=4, bucket_size=50).report().split("\n")
    assert report[0] == "samples: 4" and report[2] == "empty_text: 1"
    assert report[4] == "min: 0 max: 100 mean: 27.75"
    assert report[-3:] == [
        "     0-49          3 ( 75.0%)",
        "    50-99          0 (  0.0%)",
        "   100-149         1 ( 25.0%)",
    ]
    none = profile_corpus(spark, str(tmp_path / "in.json"), max_samples=-1).report()
    assert none.startswith("samples: 0") and none.endswith("     0-199         0 (  0.0%)")


def pairs(spark, out):
    stored = spark.read.parquet(*expand_paths(spark, f"{out}/slice=*/*.parquet"))
    assert stored.columns == ["text_en", "text_ja"]
    return [tuple(r) for r in global_ordinal(stored).orderBy("ordinal").drop("ordinal").collect()]


def test_translation_resumes_where_it_stopped(spark, numbered_files, tmp_path):
    translate = translator(FaultyBackend(faults=(("text 9", -1),)))
    failed = lambda i: str(i).startswith("9")
    expected = [("", "") if failed(i) else (f"text {i}", f"[ja] text {i}") for i in range(100)]
    out, state = str(tmp_path / "out"), str(tmp_path / "state")
    for cap, rows in ((35, 35), (35, 35), (-1, 100)):
        assert translate_corpus(spark, numbered_files, out, translate, state, max_samples=cap, slice_rows=40) == rows
        assert pairs(spark, out) == expected[:rows]
        assert translation_progress(spark, state).first()["written"] == rows
    report = {r["status"]: r["rows"] for r in enrich_report(translation_status(spark, state)).collect()}
    assert report == {"ok": 89, "error": 11} and translation_progress(spark, state).first()["errors"] == 11
    status = translation_status(spark, state).where("status = 'error'")
    assert sorted(r["ordinal"] for r in status.collect()) == [i for i in range(100) if failed(i)]


def test_only_lost_slices_are_called_again(spark, numbered_files, tmp_path):
    """Slices without a manifest row or without their folder; success marks play no part."""
    import shutil

    folder = tmp_path / "calls"
    folder.mkdir()

    class CountingBackend(PrefixBackend):
        def connect(self):
            import uuid

            def call(text):
                with open(f"{folder}/{uuid.uuid4().hex}", "w"):
                    return self.prefix + text

            return call

    def calls():
        found = len(list(folder.iterdir()))
        for file in folder.iterdir():
            file.unlink()
        return found

    out, state, translate = str(tmp_path / "out"), str(tmp_path / "state"), translator(CountingBackend())
    for lost, expected in ((None, 100), ("mark", 0), ("folder", 10), (None, 0)):
        slices = sorted(tmp_path.glob("out/slice=*"))
        if lost == "mark":
            [(s / "_SUCCESS").unlink(missing_ok=True) for s in slices]
        if lost == "folder":
            shutil.rmtree(slices[4])
        assert translate_corpus(spark, numbered_files, out, translate, state, slice_rows=10) == 100
        assert calls() == expected
        assert pairs(spark, out) == [(f"text {i}", f"[ja] text {i}") for i in range(100)]


def test_a_killed_run_repeats_only_slices_in_flight(spark, numbered_files, tmp_path):
    out, state, seen = str(tmp_path / "out"), str(tmp_path / "state"), []
    inner = translator(PrefixBackend())

    def dying(df):
        seen.append(1)
        if len(seen) == 4:
            raise KeyboardInterrupt
        return inner(df)

    with pytest.raises(KeyboardInterrupt):
        translate_corpus(spark, numbered_files, out, dying, state, slice_rows=20, in_flight=1)
    assert translation_progress(spark, state).first()["written"] == 80
    assert translate_corpus(spark, numbered_files, out, dying, state, slice_rows=20, in_flight=1) == 100
    assert len(seen) == 6


def test_budgeted_translators_run_small_slices_one_at_a_time():
    named = translator("openai-api", settings=TranslationSettings(limits=Limits(500, 200_000)))
    assert named.slice_rows == 460 and not hasattr(translator("gpt-oss"), "slice_rows")


def test_json_lines_are_translated_in_order(spark, tmp_path):
    (tmp_path / "in").mkdir()
    for file in range(2):
        (tmp_path / "in" / f"c{file}.json").write_text("\n".join(['{"text":"%d-%d"}' % (file, i) for i in range(20)] + ['{"text":3}']))
    out = str(tmp_path / "out")
    done = translate_corpus(
        spark, f"{tmp_path}/in", out, translator(PrefixBackend()), str(tmp_path / "state"), "text", source_format="json"
    )
    assert done == 42
    one = [("%d-%d", i) for i in range(20)]
    expected = [t for f in range(2) for t in [*(f"{f}-{i}" for _, i in one), ""]]
    assert [en for en, _ in pairs(spark, out)] == expected


def test_keyed_resume(spark, tmp_path):
    source = spark.createDataFrame([(i, f"t{i}") for i in range(10)], SCHEMA)
    out = str(tmp_path / "out")
    translate = translator(PrefixBackend(), key="row_id")
    translate_pending(source.where("row_id % 3 = 0"), out, translate, "row_id")
    assert sorted(r["row_id"] for r in translate_pending(source, out, translate, "row_id").collect()) == list(range(10))


def test_backend_names():
    for name in ("gpt-oss", "openai-api", "hybrid"):
        assert callable(translator(name))
    with pytest.raises(ValueError):
        translator("other")


def test_settings_from_environment():
    env = {
        "OPENAI_BASE_URLS": "http://a/v1, ,http://b/v1",
        "OPENAI_MODEL": "m",
        "OPENAI_MAX_TOKENS": "100",
        "OPENAI_RPM": "12",
        "OPENAI_RATE_TIER": "2",
    }
    settings = TranslationSettings.from_environment(env)
    local, remote = settings.local(), settings.remote()
    assert (local.base_urls, local.model, local.max_in_flight) == (("http://a/v1", "http://b/v1"), "m", 4)
    assert (remote.model, remote.max_tokens, remote.max_in_flight) == ("gpt-5-nano", 100, 4)
    assert settings.limits == Limits(12, 2_000_000)
    wide = TranslationSettings.from_environment({}, model="x", tier="5", rpm=7, jsonl=True)
    assert (wide.local().model, wide.remote().model, wide.local().max_in_flight) == ("x", "x", 100)
    assert wide.remote(alone=True).max_in_flight == 100 and wide.backend == "gpt-oss"
    chosen = TranslationSettings.from_environment({"TRANSLATION_BACKEND": "openai-api"})
    assert chosen.backend == "openai-api" and translator(settings=chosen).slice_rows > 0
    assert wide.limits == Limits(7, 180_000_000) and wide.urls == ("http://localhost:8000/v1",)
