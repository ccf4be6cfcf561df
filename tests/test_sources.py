import gzip
import os

import pytest
from pyspark.sql import functions as F

from bitextloom.session import scoped_conf
from bitextloom.sources import (
    StateLog,
    cached_count,
    count_rows_jsonl,
    count_rows_parquet,
    expand_paths,
    file_offsets,
    first_jsonl_rows,
    global_ordinal,
    include_patterns,
    infer_format,
    resolve_max_samples,
    resolve_text_field,
    rows_between,
    scan_corpus,
    scan_from_offset,
    scan_jsonl,
    stage_jsonl,
    take_first_rows,
)

GOLDEN = [
    ('{"text":"ab"}', "ab"),
    ('{"text":null}', None),
    ('{"text":5}', None),
    ('{"text":{"k":1}}', None),
    ('{"other":1}', None),
    ('{"text":""}', ""),
    ("not json", None),
]


def numbers(df):
    return sorted(row["n"] for row in df.select("n").collect())


def test_jsonl_tells_strings_from_other_values(spark, tmp_path):
    file = tmp_path / "a.json"
    file.write_text("\n".join(line for line, _ in GOLDEN))
    with gzip.open(tmp_path / "b.json.gz", "wt") as packed:
        packed.write('{"text":"packed"}\n')
    texts = [row["text"] for row in scan_jsonl(spark, str(file)).collect()]
    assert texts == [text for _, text in GOLDEN]
    both = scan_jsonl(spark, str(tmp_path / "*.json*"))
    assert both.count() == len(GOLDEN) + 1
    assert both.where("text = 'packed'").count() == 1


def test_infer_format():
    assert infer_format("A/B.PARQUET") == infer_format("x.pq?y") == "parquet"
    assert infer_format("c4.json.gz") == "json"
    assert infer_format("x.parquet", "json") == "json"


def test_expand_paths(spark, tmp_path):
    for name in ("b.parquet", "a.parquet", "note.txt", ".hidden.parquet", "d/c.parquet"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(b"")
    root = str(tmp_path)
    spec = f" {root}/b.parquet,, {root} ,{root}/d/*.parquet,{root}/note.txt,{root}/none.parquet,{root}/no*"
    names = [os.path.relpath(path, root) for path in expand_paths(spark, spec)]
    assert names == ["a.parquet", "b.parquet", "d/c.parquet", "note.txt"]
    assert expand_paths(spark, f"{root}/missing, ") == []
    assert include_patterns(spark, root, "d/*.parquet", "e/*") == [f"{root}/d/c.parquet"]


def test_resolve_text_field():
    assert resolve_text_field(["text", "en_text"]) == "text"
    assert resolve_text_field(["en_text"]) == "en_text"
    assert resolve_text_field(["en_text"], "body") == "body"


def test_positions_follow_sorted_files(spark, numbered_files):
    df = spark.read.parquet(numbered_files)
    with scoped_conf(spark, spark__sql__files__maxPartitionBytes="600"):
        rows = global_ordinal(df).select("n", "ordinal").collect()
    assert sorted(rows) == [(n, n) for n in range(100)]
    starts = [row["start"] for row in file_offsets(df).orderBy("file_path").collect()]
    assert starts in ([0, 30, 31, 75], [0, 30, 30, 31, 75])


@pytest.mark.parametrize("skip", [0, 1, 29, 30, 31, 75, 99, 100, 500])
def test_scan_from_offset(spark, numbered_files, skip):
    df = spark.read.parquet(numbered_files)
    assert numbers(scan_from_offset(df, skip)) == list(range(skip, 100))


@pytest.mark.parametrize("cap", [-1, 0, 1, 30, 31, 32, 99, 100, 500])
def test_take_first_rows(spark, numbered_files, cap):
    df = spark.read.parquet(numbered_files)
    assert numbers(take_first_rows(df, cap)) == list(range(100 if cap < 0 else min(cap, 100)))


def test_rows_between_reads_only_its_files(spark, numbered_files):
    df = spark.read.parquet(numbered_files)
    part = rows_between(df, 30, 76, file_offsets(df))
    assert sorted(part.select("n", "ordinal").collect()) == [(n, n) for n in range(30, 76)]
    assert part.select(F.col("n")).where("n < 30").count() == 0
    assert rows_between(df, 100, 120, file_offsets(df)).count() == 0


def test_jsonl_positions_over_many_splits(spark, tmp_path):
    for file in range(3):
        lines = [f'{{"text":"{file}-{i}"}}' + ("\n" if i % 50 == 0 else "") for i in range(200)]
        (tmp_path / f"c{file}.json").write_text("\n".join(lines))
    paths = expand_paths(spark, f"{tmp_path}/*.json")
    with scoped_conf(spark, spark__sql__files__maxPartitionBytes="700"):
        staged = stage_jsonl(spark, paths)
    expected = [(f * 200 + i, f'{{"text":"{f}-{i}"}}') for f in range(3) for i in range(200)]
    assert sorted(map(tuple, staged.collect())) == expected
    assert sorted(map(tuple, first_jsonl_rows(spark, paths, 250).collect())) == expected[:250]
    assert first_jsonl_rows(spark, paths, 0).count() == 0


def test_scan_corpus_caps_and_falls_back(spark, tmp_path, numbered_files):
    assert scan_corpus(spark, f"{numbered_files}/*.parquet", cap=3).count() == 3
    file = tmp_path / "x.json"
    file.write_text('{"en_text":"a"}\n{"en_text":"b"}\n')
    assert [row["text"] for row in scan_corpus(spark, str(file)).collect()] == ["a", "b"]
    assert [row["text"] for row in scan_corpus(spark, str(file), cap=1).collect()] == ["a"]
    assert scan_corpus(spark, str(file), fall_back=False).where("text IS NULL").count() == 2
    missing = scan_corpus(spark, f"{numbered_files}/*.parquet", text_field="body")
    assert missing.where("text IS NULL").count() == 100
    with pytest.raises(FileNotFoundError):
        scan_corpus(spark, f"{tmp_path}/none/*.json")


def test_parquet_counts(spark, numbered_files, tmp_path):
    paths = expand_paths(spark, numbered_files)
    assert count_rows_parquet(spark, paths, "en_text") == 100
    assert count_rows_parquet(spark, paths, "absent") is None
    broken = tmp_path / "broken.parquet"
    broken.write_bytes(b"not parquet")
    assert count_rows_parquet(spark, [*paths, str(broken)], "en_text") is None


def test_jsonl_count_includes_an_unterminated_line(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"text":"x"}\n{"text":"y"}')
    assert count_rows_jsonl(spark, str(tmp_path / "a.json")) == 2


def test_cached_count_notices_new_files(spark, numbered_files, tmp_path):
    import pyarrow as pa
    import pyarrow.parquet as pq

    state, pattern = str(tmp_path / "state"), f"{numbered_files}/*.parquet"

    def count():
        return cached_count(spark, state, pattern, expand_paths(spark, pattern), "en_text")

    assert count() == count() == 100
    assert StateLog(spark, state, "pattern string, files string, count bigint").latest()["version"] == 0
    pq.write_table(pa.table({"n": [100], "en_text": ["new"]}), f"{numbered_files}/part-900.parquet")
    assert count() == 101
    assert resolve_max_samples(spark, 7, state, pattern, [], "en_text") == 7


def test_state_log(spark, tmp_path):
    log = StateLog(spark, str(tmp_path / "log"))
    assert log.latest() is None
    log.append(processed=5, written=4, shard_id=1)
    log.append(processed=9, written=9, shard_id=2)
    again = StateLog(spark, str(tmp_path / "log")).latest()
    assert (again["version"], again["processed"], again["written"], again["shard_id"]) == (1, 9, 9, 2)
    assert again["updated_at"] > 1_600_000_000


def test_shared_folder_is_the_clusters_unless_it_names_none(spark):
    from types import SimpleNamespace

    from bitextloom.session import scratch_path, shared_folder

    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        assert shared_folder(spark) == named.rstrip("/")

    class Context:
        folder, master = None, "local[4]"

        def getCheckpointDir(self):
            return self.folder

        def setCheckpointDir(self, folder):
            self.folder = f"{folder}/unique"

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: default), sparkContext=Context())
    first, second = scratch_path(bare, "x"), scratch_path(bare, "x")
    assert first != second and first.startswith(bare.sparkContext.folder)
    on_a_cluster = SimpleNamespace(conf=bare.conf, sparkContext=Context())
    on_a_cluster.sparkContext.master = "spark://host:7077"
    with pytest.raises(ValueError):
        shared_folder(on_a_cluster)


def test_counts_come_from_footers(spark, numbered_files):
    from bitextloom.sources import footer_count, pushdown

    paths = expand_paths(spark, numbered_files)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with pushdown(spark):
        counted = footer_count(spark, paths)
        plan = counted._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)]" in plan and counted.first()["rows"] == 100
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before


def test_a_file_without_the_column_makes_the_count_unknown(spark, tmp_path):
    """Stored nulls are values; a missing column is not, and neither is one of another name in its place."""
    import pyarrow as pa
    import pyarrow.parquet as pq

    from bitextloom.sources import unreadable_files

    def write(name, **columns):
        pq.write_table(pa.table(columns), tmp_path / f"{name}.parquet")
        return str(tmp_path / f"{name}.parquet")

    full, partly = write("a", n=[1, 2], t=["x", "y"]), write("b", t=["x", None, "z"])
    nulls, empty = write("c", t=pa.array([None, None], pa.string())), write("d", t=pa.array([], pa.string()))
    other, number = write("e", n=[1, 2, 3]), write("f", t=[1, 2])
    assert count_rows_parquet(spark, [full, partly, nulls, empty], "t") == 7
    assert count_rows_parquet(spark, [full, other], "t") is None and count_rows_parquet(spark, [other, nulls], "t") is None
    assert count_rows_parquet(spark, [number], "t") == 2 and count_rows_parquet(spark, [empty], "t") == 0
    assert count_rows_parquet(spark, [], "t") == 0
    broken = [str(tmp_path / f"x{i}.parquet") for i in range(2)]
    for path in broken:
        with open(path, "w") as file:
            file.write("PAR1 no")
    assert unreadable_files(spark, [full, broken[0], partly, nulls, broken[1], empty]) == broken


def test_only_new_and_changed_files_are_counted(spark, numbered_files, tmp_path):
    import os

    import pyarrow as pa
    import pyarrow.parquet as pq

    from bitextloom.sources import count_new_files, counted_files

    state = str(tmp_path / "state")

    def count(column="en_text"):
        return count_new_files(spark, state, expand_paths(spark, numbered_files), column)

    def opened():
        return counted_files(spark, state).count()

    files = len(expand_paths(spark, numbered_files))
    assert (count(), opened()) == (100, files) and (count(), opened()) == (100, files)
    os.utime(expand_paths(spark, numbered_files)[0], (1, 1))
    assert (count(), opened()) == (100, files + 1)
    pq.write_table(pa.table({"n": [100], "en_text": ["new"]}), f"{numbered_files}/part-900.parquet")
    assert (count(), opened()) == (101, files + 2)
    assert count("n") == 101 and opened() == 2 * files + 3
    pq.write_table(pa.table({"n": [100]}), f"{numbered_files}/part-901.parquet")
    assert count() is None and opened() == 2 * files + 3
