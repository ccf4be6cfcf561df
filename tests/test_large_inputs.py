"""Queries that write files for themselves write more of them for a larger table, and a task holds parts of a batch."""

import pandas as pd
import pytest

from bitextloom.catalog import QUERIES, runs
from bitextloom.operators import PrefixBackend, enrich


@pytest.fixture
def tables(spark, tmp_path):
    rows = [(i, None if i % 9 == 4 else f"text {i}", "en", "a") for i in range(60)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_appended_lines_of_many_files(spark, tables, monkeypatch):
    seen = []
    monkeypatch.setattr(runs, "FILE_ROWS", 10)
    monkeypatch.setattr(runs, "process_appended", lambda s, folder, *rest, take=runs.process_appended: (seen.append(folder), take(s, folder, *rest)))
    got = {(r["doc_id"], r["text"], r["run"]) for r in QUERIES["appended_lines"](spark, tables).collect()}
    assert got == {(i, None if i % 9 == 4 else f"text {i}", int(i % 4 == 3)) for i in range(60)}
    names = runs.list_files(spark, seen[0], "*.json").select("name", "bytes").collect()
    assert len(names) > 4 and max(r["bytes"] for r in names) < sum(r["bytes"] for r in names) / 3


@pytest.mark.parametrize("name", ["profile_corpus", "translate_corpus"])
def test_sources_of_many_files(spark, tables, monkeypatch, name):
    before = sorted(map(str, QUERIES[name](spark, tables).collect()))
    seen = []
    monkeypatch.setattr(runs, "FILE_ROWS", 5)
    monkeypatch.setattr(runs, name, lambda s, files, *rest, take=getattr(runs, name), **more: (seen.append(files), take(s, files, *rest, **more))[1])
    assert sorted(map(str, QUERIES[name](spark, tables).collect())) == before
    held = spark.read.parquet(*runs.expand_paths(spark, seen[0]))
    assert held.select("_metadata.file_path").distinct().count() >= 12 - 1


def test_a_large_batch_is_called_in_parts(monkeypatch):
    taken = []

    def batches():
        yield pd.DataFrame({"k": range(1000), "text_en": [f"t{i}" for i in range(1000)]})
        taken.append("all")

    backend = PrefixBackend()
    columns = ["k", "text_en", "text_ja", "status", "error", "attempts"]
    found = enrich._enrich_batches(batches(), {backend.name: backend}, {}, {}, "text_en", columns)
    first = next(found)
    assert len(first) == enrich.PART_ROWS and not taken
    whole = pd.concat([first, *found])
    assert whole["k"].tolist() == list(range(1000)) and whole["text_ja"].tolist() == [f"[ja] t{i}" for i in range(1000)]
