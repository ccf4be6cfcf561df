import random

from bitextloom import prefix
from bitextloom.prefix import running_total
from bitextloom.sources import global_ordinal


def test_both_ways_give_the_same_totals(spark, monkeypatch):
    chance = random.Random(2)
    rows = [(f"f{i:04d}", chance.randrange(100)) for i in range(300)]
    expected, total = {}, 0
    for name, value in rows:
        expected[name] = total
        total += value
    chance.shuffle(rows)
    df = spark.createDataFrame(rows, "f string, v bigint")

    def totals():
        return {r["f"]: r["s"] for r in running_total(df, ["f"], "v", "s", 300).collect()}

    assert totals() == expected
    monkeypatch.setattr(prefix, "ONE_TASK_ROWS", 40)
    assert totals() == expected


def test_positions_with_many_files_and_no_broadcast(spark, numbered_files, monkeypatch):
    from bitextloom.sources import positions

    monkeypatch.setattr(prefix, "ONE_TASK_ROWS", 1)
    monkeypatch.setattr(positions, "BROADCAST_FILES", 0)
    rows = global_ordinal(spark.read.parquet(numbered_files)).select("n", "ordinal").collect()
    assert sorted(rows) == [(n, n) for n in range(100)]
