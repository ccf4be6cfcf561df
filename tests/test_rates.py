import random
from collections import defaultdict

from pyspark.sql import functions as F

from bitextloom.functions import Limits
from bitextloom.operators import Budget, endpoint_of, rate_window_usage, round_robin_assign, tier_plan

MINUTE = 60_000_000


def brute_force(log, limits):
    result = {}
    for key, (backend, at, tokens) in enumerate(log):
        inside = [
            max(1, min(t, limits.tpm)) for b, s, t in log if b == backend and at is not None and s is not None and at - MINUTE < s <= at
        ]
        result[key] = (len(inside), sum(inside)) if at is not None else (None, None)
    return result


def audit(spark, log, limits):
    rows = [(i, *entry) for i, entry in enumerate(log)]
    df = spark.createDataFrame(rows, "id bigint, backend string, ts bigint, tokens bigint")
    audited = rate_window_usage(df, limits).collect()
    assert len(audited) == len(log)
    return {r["id"]: (r["requests_60s"], r["tokens_60s"]) for r in audited}


def test_entry_expires_at_sixty_seconds(spark):
    log = [("a", 0, 5), ("a", MINUTE - 1, 7), ("a", MINUTE, 9), ("b", MINUTE, 1)]
    assert audit(spark, log, Limits(10, 100)) == {0: (1, 5), 1: (2, 12), 2: (2, 16), 3: (1, 1)}


def test_window_equals_brute_force(spark):
    """Ties, a backend with most of the rows, a missing backend, a missing time, times before 1970."""
    chance = random.Random(3)
    log = [
        (chance.choice(["hot"] * 6 + ["cold", None]), chance.randrange(-3 * MINUTE, 4 * MINUTE, 500_000), chance.randrange(0, 60))
        for _ in range(400)
    ]
    log += [("hot", MINUTE, 3)] * 150 + [("hot", None, 1)]
    limits = Limits(50, 40)
    assert audit(spark, log, limits) == brute_force(log, limits)


def test_tier_plan_reproduces_the_published_corpus(spark):
    rows = 32_935_629
    totals = spark.createDataFrame([(rows, rows * 4331)], "requests bigint, tokens bigint")
    plan = {r["tier"]: r for r in tier_plan(totals).collect()}
    assert [plan[t]["requests_per_minute"] for t in "12345"] == [46, 461, 923, 2308, 30000]
    days = [plan[t]["min_minutes"] / 1440 for t in "12345"]
    assert [round(d, 1) for d in days] == [497.2, 49.6, 24.8, 9.9, 0.8]


def test_tier_plan_without_requests(spark):
    totals = spark.createDataFrame([(0, 0)], "requests bigint, tokens bigint")
    row = tier_plan(totals).where("tier = '1'").first()
    assert (row["requests_per_minute"], row["min_minutes"]) == (500, 0.0)


def test_round_robin_follows_weights(spark):
    df = round_robin_assign(spark.range(-4, 12).toDF("ordinal"), {"a": 3, "b": 1})
    assert "".join(r["backend"] for r in df.orderBy("ordinal").collect()) == "aaab" * 4
    urls = [r[0] for r in spark.range(4).select(endpoint_of(F.col("id"), ["u", "v", "w"])).collect()]
    assert urls == ["u", "v", "w", "u"]


class Clock:
    def __init__(self):
        self.now = 0

    def time(self):
        return self.now

    def sleep(self, seconds):
        assert seconds > 0
        self.now += seconds


def test_budget_never_exceeds_a_window():
    chance, clock = random.Random(11), Clock()
    limits = Limits(rpm=7, tpm=100)
    budget = Budget(limits, clock.time, clock.sleep)
    log = []
    for _ in range(300):
        clock.now += chance.randrange(4)
        size = chance.choice([1, 5, 20, 60, 500, 0])
        budget.spend(size)
        log.append((clock.now, max(1, min(size, limits.tpm))))
    usage = defaultdict(int)
    for now, _ in log:
        window = [t for at, t in log if now - 60 < at <= now]
        usage["requests"] = max(usage["requests"], len(window))
        usage["tokens"] = max(usage["tokens"], sum(window))
    assert usage["requests"] == 7 and 90 <= usage["tokens"] <= 100


def test_budget_waits_no_longer_than_needed():
    clock = Clock()
    budget = Budget(Limits(rpm=2, tpm=100), clock.time, clock.sleep)
    budget.spend(50)
    clock.now = 10
    budget.spend(50)
    budget.spend(50)
    assert clock.now == 60
    budget.spend(100)
    assert clock.now == 120
