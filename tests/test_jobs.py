from __future__ import annotations

import threading
import time

import pytest
from pyspark.sql import functions as F

from ordermill.jobs import run_all


def test_results_by_name(spark):
    assert run_all(spark, {"a": lambda: spark.range(3).count(), "b": lambda: spark.range(5).count()}) == {"a": 3, "b": 5}
    assert run_all(spark, {}) == {}


def test_tasks_run_at_the_same_time_with_tags_and_pools_of_their_own(spark):
    meet, seen = threading.Barrier(3, timeout=60), {}

    def task(name):
        meet.wait()
        context = spark.sparkContext
        seen[name] = (frozenset(context.getJobTags()), context.getLocalProperty("spark.scheduler.pool"))
        return spark.range(1).count()

    run_all(spark, {n: lambda n=n: task(n) for n in "xyz"})
    assert {pool for _, pool in seen.values()} == {"x", "y", "z"}
    assert len({tags for tags, _ in seen.values()}) == 1 and not spark.sparkContext.getJobTags()


def slow(spark, started):
    def run():
        started.set()
        wait = F.udf(lambda n: time.sleep(60) or n, "long")
        return spark.range(0, 2, 1, 2).select(wait("id").alias("n")).agg(F.sum("n")).collect()

    return run


def test_a_failure_cancels_the_others(spark):
    started = threading.Event()

    def fail():
        started.wait(60)
        time.sleep(1)
        raise ValueError("broken table")

    begin = time.time()
    with pytest.raises(ExceptionGroup, match="2 of 2 tasks") as failure:
        run_all(spark, {"slow": slow(spark, started), "bad": fail})
    assert time.time() - begin < 45
    assert any("broken table" in str(e) and e.__notes__ == ["while running bad"] for e in failure.value.exceptions)


def test_waiting_tasks_do_not_start_after_a_failure(spark):
    ran = []

    def fail():
        raise ValueError("no")

    with pytest.raises(ExceptionGroup):
        run_all(spark, {"bad": fail, **{str(i): lambda i=i: time.sleep(0.2) or ran.append(i) for i in range(6)}}, at_once=1)
    assert len(ran) <= 1


def test_failures_may_be_kept_apart(spark):
    def fail():
        raise ValueError("no")

    out = run_all(spark, {"a": lambda: 1, "bad": fail, "c": lambda: 3}, stop_on_failure=False)
    assert out["a"] == 1 and out["c"] == 3 and isinstance(out["bad"], ValueError)
