"""Files that grow: every line is taken once, by the run that follows it."""

import json

from bitextloom.streaming import AppendedLines, numbered_lines, process_appended


def put(path, values, mode="a"):
    with open(path, mode) as file:
        file.writelines(json.dumps({"v": v}) + "\n" for v in values)


def run(spark, tmp_path):
    number = process_appended(
        spark, str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "state"), lambda lines: lines.selectExpr("file", "line", "from_json(value, 'v long').v AS v")
    )
    rows = spark.read.parquet(f"{tmp_path}/out/run={number}").collect()
    return number, sorted((r["file"].rsplit("/", 1)[1], r["line"], r["v"]) for r in rows)


def test_each_run_takes_what_was_appended(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder / "a b.json", [1, 2])
    put(folder / "c.json", [3])
    (folder / "none.json").touch()
    assert run(spark, tmp_path) == (0, [("a b.json", 0, 1), ("a b.json", 1, 2), ("c.json", 0, 3)])
    number, rows = run(spark, tmp_path)
    assert rows == []
    put(folder / "c.json", [4, 5])
    put(folder / "d.json", [6])
    assert run(spark, tmp_path)[1] == [("c.json", 1, 4), ("c.json", 2, 5), ("d.json", 0, 6)]
    with open(folder / "d.json", "a") as file:
        file.write('\n  \n{"v": 7}')
    assert run(spark, tmp_path)[1] == [("d.json", 3, 7)]
    put(folder / "a b.json", [8], "w")
    assert run(spark, tmp_path)[1] == [("a b.json", 0, 8)], "a shorter file is another one"
    assert run(spark, tmp_path)[1] == []


def test_a_run_that_broke_off_is_repeated(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    put(folder / "a.json", [1])
    pending = AppendedLines(spark, str(folder), str(tmp_path / "state")).pending()
    assert pending.count() == 1
    put(folder / "a.json", [2])
    assert run(spark, tmp_path) == (0, [("a.json", 0, 1), ("a.json", 1, 2)])


def test_only_files_of_another_size_are_read(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    for i in range(5):
        put(folder / f"{i}.json", [i])
    run(spark, tmp_path)
    put(folder / "3.json", [9])
    lines = AppendedLines(spark, str(folder), str(tmp_path / "state"))
    assert [r["value"] for r in lines.pending().collect()] == ['{"v": 9}']
    assert [(r["file"].rsplit("/", 1)[1], r["lines"]) for r in lines.read.collect()] == [("3.json", 2)]


def test_lines_of_a_file_in_many_splits(spark, tmp_path):
    path = tmp_path / "big.json"
    path.write_text("".join(f"{i} {'x' * (i % 90)}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "50000")
    try:
        lines = numbered_lines(spark, [str(path)])
        assert lines.count() == 20_000 and lines.where("line <> cast(split(value, ' ')[0] AS bigint)").count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
