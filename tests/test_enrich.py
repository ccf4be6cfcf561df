import sys
import types

import pytest

from bitextloom.functions import Limits
from bitextloom.operators import (
    Backend,
    FaultyBackend,
    PrefixBackend,
    api_chat,
    budget_slots,
    calling_profile,
    enrich_report,
    enrich_text,
    enrich_to_table,
    hybrid_enrich,
    local_chat,
    rate_budgeted_enrich,
    reassemble_in_order,
    resume_pending,
)
from bitextloom.operators.enrich import Budget, call_with_retries, request_tokens


def failing(times, message="boom"):
    left = [times]

    def call(text):
        if left[0]:
            left[0] -= 1
            raise RuntimeError(message)
        return text.upper()

    return call


@pytest.mark.parametrize("times, status, calls", [(0, "ok", 1), (1, "ok", 2), (2, "ok", 3), (3, "error", 3)])
def test_three_tries(times, status, calls):
    slept = []
    result = call_with_retries(failing(times), "a", wait_out=False, sleep=slept.append)
    assert result == ("A" if status == "ok" else "", status, None if status == "ok" else "boom", calls)
    assert slept == [0.5, 1.0][: min(times, 2)]


def test_rate_limits_do_not_use_up_tries_where_they_are_waited_out():
    slept = []
    limit = failing(5, "Rate limit: try again in 20ms")
    assert call_with_retries(limit, "a", wait_out=True, sleep=slept.append) == ("A", "ok", None, 6)
    assert slept == [0.02] * 5
    limit = failing(5, "429")
    assert call_with_retries(limit, "a", wait_out=False, sleep=slept.append)[1] == "error"


def test_missing_content_is_empty_text():
    assert call_with_retries(lambda text: None, "a", wait_out=False) == ("", "ok", None, 1)


def test_request_tokens_match_the_column_form():
    assert request_tokens("x") == 4331 and request_tokens("") == 4330


def test_enrich_keeps_order_and_isolates_failures(texts):
    df = texts("a", None, "bad one", "", "slow one", "c").coalesce(1)
    backend = FaultyBackend(faults=(("bad", -1), ("slow", 2)), max_in_flight=3)
    rows = [tuple(r) for r in enrich_text(df, backend, retry_step=0.0).collect()]
    assert rows == [
        (0, "a", "[ja] a", "ok", None, 1),
        (1, "", "", "blank", None, 0),
        (2, "", "", "error", "model error", 3),
        (3, "", "", "blank", None, 0),
        (4, "slow one", "[ja] slow one", "ok", None, 3),
        (5, "c", "[ja] c", "ok", None, 1),
    ]
    kept = enrich_text(df, backend, on_error="keep_source", retry_step=0.0).where("row_id = 2").first()
    assert (kept["text_en"], kept["text_ja"], kept["status"]) == ("bad one", "", "error")


def test_many_batches_and_threads(spark):
    df = spark.range(3000).selectExpr("id AS row_id", "concat('t', id) AS text").coalesce(2)
    rows = enrich_text(df, PrefixBackend(max_in_flight=8)).collect()
    assert [r["row_id"] for r in rows] == list(range(3000))
    assert all(r["text_ja"] == f"[ja] t{r['row_id']}" for r in rows)


def test_empty_input(texts):
    assert enrich_text(texts(), PrefixBackend()).count() == 0


def test_stored_result_is_not_computed_again(texts, tmp_path):
    folder = tmp_path / "calls"
    folder.mkdir()

    class CountingBackend(Backend):
        """Leaves one file per call, so that calls over all tasks can be counted."""

        def connect(self):
            import uuid

            def call(text):
                with open(f"{folder}/{uuid.uuid4().hex}", "w"):
                    return text

            return call

    stored = enrich_to_table(enrich_text(texts("a", "b", ""), CountingBackend()), str(tmp_path / "out"))
    assert sorted(map(tuple, enrich_report(stored).collect())) == [("blank", 1), ("ok", 2)]
    assert stored.count() == 3 and len(list(folder.iterdir())) == 2


def test_hybrid_takes_rows_by_free_capacity(spark):
    """A slow backend holds up few rows, every row is done once, and keys may be strings."""
    import time

    class SlowBackend(PrefixBackend):
        """Takes a tenth of a second for each text."""

        def connect(self):
            import time

            def call(text):
                time.sleep(0.1)
                return self.prefix + text

            return call

    df = spark.range(400).selectExpr("concat('k', id) AS row_id", "concat('t', id) AS text").coalesce(1)
    both = [PrefixBackend("fast", 2, prefix="1"), SlowBackend("slow", 2, prefix="2")]
    hybrid_enrich(df.limit(4), both).collect()
    started = time.time()
    rows = hybrid_enrich(df, both).collect()
    assert time.time() - started < 3
    assert sorted(r["row_id"] for r in rows) == sorted(f"k{i}" for i in range(400))
    assert all(r["text_ja"][0] == {"fast": "1", "slow": "2"}[r["backend"]] for r in rows)
    taken = [r["backend"] for r in rows]
    assert 0 < taken.count("slow") < 40


def test_hybrid_budgets_only_the_named_backend(spark):
    df = spark.range(40).selectExpr("id AS row_id", "'t' AS text")
    both = [PrefixBackend("one", 2, prefix="1"), PrefixBackend("two", 2, prefix="2")]
    done = hybrid_enrich(df, both, limits={"two": Limits(3000, 30_000_000)}, tasks=3)
    assert done.rdd.getNumPartitions() == 3
    assert sorted(r["row_id"] for r in done.collect()) == list(range(40))


def test_tasks_merge_or_widen(spark):
    df = spark.range(40).selectExpr("id AS row_id", "'t' AS text").coalesce(2)
    for tasks in (1, 2, 9):
        assert enrich_text(df, PrefixBackend(), tasks=tasks).rdd.getNumPartitions() == tasks


def test_shares_admit_the_largest_request(spark):
    """On a virtual clock no 60 seconds hold more than the budget, at 64 slots and with texts of any size."""
    sizes = [1, 90, 2400, 30_000]
    limits = Limits(500, 200_000)

    class Wide:
        class sparkContext:
            defaultParallelism = 64

    slots = budget_slots(Wide, limits, largest=request_tokens("x" * max(sizes)))
    assert slots == 200_000 // request_tokens("x" * max(sizes))
    log, share = [], limits.split(slots)
    for slot in range(slots):
        now = [0.0]
        budget = Budget(share, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
        for i in range(60):
            tokens = request_tokens("x" * sizes[(i + slot) % 4])
            budget.spend(tokens)
            log.append((now[0], tokens))
    log.sort()
    for at, _ in log:
        recent = [t for s, t in log if at - 60 < s <= at]
        assert sum(recent) <= limits.tpm and len(recent) <= limits.rpm


def test_budget_is_split_over_one_wave(spark):
    assert budget_slots(spark, Limits(30_000, 180_000_000)) == spark.sparkContext.defaultParallelism
    assert budget_slots(spark, Limits(500, 9_000)) == 2
    assert budget_slots(spark, Limits(1, 100)) == 1
    assert budget_slots(spark, Limits(500, 200_000), wanted=1000) == spark.sparkContext.defaultParallelism
    assert budget_slots(spark, Limits(500, 200_000), largest=150_000) == 1
    df = spark.range(50).selectExpr("id AS row_id", "concat('t', id) AS text")
    done = rate_budgeted_enrich(df, PrefixBackend(), Limits(3000, 30_000_000), tasks=3)
    assert done.rdd.getNumPartitions() == 3
    assert sorted(r["row_id"] for r in done.where("text_ja = concat('[ja] ', text_en)").collect()) == list(range(50))


def test_budgeted_calls_run_in_one_wave_or_not_at_all(spark):
    df = spark.range(50).selectExpr("id AS row_id", "concat('t', id) AS text")
    done = rate_budgeted_enrich(df, PrefixBackend(), Limits(3000, 30_000_000), tasks=3)
    plans = done._jdf.queryExecution().optimizedPlan()
    assert "true" in plans.toString().split("MapInPandas", 1)[1].splitlines()[0], "a barrier stage"

    slots = spark.sparkContext.defaultParallelism
    wave = df.repartition(slots + 1).mapInPandas(lambda batches: batches, df.schema, barrier=True)
    with pytest.raises(Exception, match="slots"):
        wave.collect()
    plain = enrich_text(df, PrefixBackend())._jdf.queryExecution().optimizedPlan()
    assert "true" not in plain.toString().split("MapInPandas", 1)[1].splitlines()[0]


def test_the_calling_stage_has_resources_of_its_own(spark):
    profile = calling_profile(2, gpu=0.25)
    wanted = {name: request.amount for name, request in profile.taskResources.items()}
    assert wanted == {"cpus": 2.0, "gpu": 0.25}
    df = spark.range(5).selectExpr("id AS row_id", "'t' AS text")
    for frame in (enrich_text(df, PrefixBackend(), profile=profile), hybrid_enrich(df, [PrefixBackend()], profile=profile)):
        assert f"id = {profile.id}" in frame._jdf.queryExecution().logical().toString()


def test_budget_is_spent_on_every_try():
    budget = Budget(Limits(100, 10**9))
    call_with_retries(failing(2), "a", False, budget, retry_step=0.0)
    assert len(budget.spent) == 3


def test_resume_and_reassemble(texts):
    source = texts("a", "b", "a", None)
    done = source.where("row_id = 0")
    assert sorted(r["row_id"] for r in resume_pending(source, done).collect()) == [1, 2, 3]
    nulls = source.selectExpr("nullif(row_id, 0) AS row_id", "text")
    assert sorted(r["row_id"] for r in resume_pending(nulls, nulls.where("row_id IS NULL")).collect()) == [1, 2, 3]
    results = source.where("row_id > 1").selectExpr("row_id", "'x' AS text_ja")
    whole = reassemble_in_order(source, results).orderBy("row_id").collect()
    assert [r["text_ja"] for r in whole] == [None, None, "x", "x"]


def fake_client(monkeypatch, calls):
    class OpenAI:
        def __init__(self, **options):
            self.options = options
            create = types.SimpleNamespace(create=self.create)
            self.chat = types.SimpleNamespace(completions=create)

        def create(self, **request):
            calls.append((self.options, request))
            message = types.SimpleNamespace(content=None if request["messages"][-1]["content"] == "none" else "訳")
            return types.SimpleNamespace(choices=[types.SimpleNamespace(message=message)])

    monkeypatch.setitem(sys.modules, "openai", types.SimpleNamespace(OpenAI=OpenAI))


def test_chat_backends_send_their_own_parameters(monkeypatch):
    calls = []
    fake_client(monkeypatch, calls)
    monkeypatch.setenv("OPENAI_API_KEY", "k")
    local = local_chat(("http://a/v1", "http://b/v1"))
    call = local.connect()
    assert [call("hello"), call("none")] == ["訳", None]
    assert [options["base_url"] for options, _ in calls] == ["http://a/v1", "http://b/v1"]
    request = calls[0][1]
    assert (request["model"], request["temperature"], request["max_tokens"]) == ("openai/gpt-oss-20b", 0.3, 4096)
    assert [m["role"] for m in request["messages"]] == ["system", "user", "assistant", "user", "assistant", "user"]
    remote = api_chat()
    remote.connect()("hello")
    options, request = calls[-1]
    assert options == {"api_key": "k"} and request["model"] == "gpt-5-nano"
    assert request["max_completion_tokens"] == 4096 and "temperature" not in request
    assert remote.waits_out_rate_limits and not local.waits_out_rate_limits
