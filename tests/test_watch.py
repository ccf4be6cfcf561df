"""A run that breaks off half way has pending rows, and none once it has gone on."""

import os

from pyspark.sql import functions as F

from bitextloom.streaming import incremental_filter, read_new_files, run_state, wait_for_stop


def test_stopped_half_way_and_finished(spark, tmp_path):
    source, watch, flag = str(tmp_path / "in"), str(tmp_path / "watch"), str(tmp_path / "broken")
    for i in range(4):
        spark.range(10 * i, 10 * i + 10 + i).select("id", F.lit("some text").alias("text")).coalesce(1).write.mode("append").parquet(source)
    assert run_state(spark, watch, source).first().asDict() == {
        "alive": False, "files_done": 0, "files_in_flight": 0, "files_pending": 4, "rows_done": 0, "rows_in_flight": 0, "rows_pending": 46,
    }
    open(flag, "w").close()
    seen = []

    @F.udf("string")
    def text_or_break(i, text):
        if 20 <= i < 30 and os.path.exists(flag):
            raise ValueError("broken off")
        return text

    def run():
        stream = read_new_files(spark, source, "id bigint, text string", files_per_batch=1)
        stream = stream.withColumn("text", text_or_break("id", "text"))
        query = incremental_filter(stream, str(tmp_path / "out"), str(tmp_path / "mark"), watch=watch)
        while query.isActive:
            if os.path.exists(watch):
                state = run_state(spark, watch, source).first()
                seen.append((state["alive"], state["rows_in_flight"]))
        assert wait_for_stop(spark, watch)
        return run_state(spark, watch, source).first()

    half = run()
    assert not half["alive"] and half["rows_in_flight"] == 0
    assert 0 < half["rows_pending"] < 46 and half["files_pending"] == 4 - half["files_done"] > 0
    assert half["rows_done"] + half["rows_pending"] == 46
    assert any(alive and flying for alive, flying in seen), "a batch was seen in flight"
    os.remove(flag)
    for _ in range(100):
        whole = run()
        if not whole["rows_pending"]:
            break
    assert (whole["files_done"], whole["files_pending"], whole["rows_done"], whole["rows_pending"]) == (4, 0, 46, 0)
