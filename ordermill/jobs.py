"""Several Spark jobs at once from one driver.

Writes of small tables leave most executors idle, so they are submitted side by side. Each runs in a thread of its own with
a job tag and, where the scheduler is fair, a pool of its own, so that a large table does not starve the small ones.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from concurrent.futures import FIRST_EXCEPTION, ThreadPoolExecutor, wait
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

AT_ONCE = 8


def run_all(
    spark: SparkSession, tasks: Mapping[str, Callable[[], Any]], at_once: int = AT_ONCE, stop_on_failure: bool = True
) -> dict[str, Any]:
    """Results of all tasks by name; those that failed give their exception.

    With `stop_on_failure` the first failure cancels the jobs of the others and keeps waiting ones from starting, and all
    exceptions are raised together. Without it every task runs to its end.
    """
    tag = f"ordermill-{uuid.uuid4().hex}"
    stopped = False

    def tagged(name: str, task: Callable[[], Any]) -> Any:
        if stopped:
            raise RuntimeError(f"{name} was not started, as another task failed")
        context = spark.sparkContext
        context.addJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", name)
        try:
            return task()
        except Exception as error:
            error.add_note(f"while running {name}")
            raise
        finally:
            context.removeJobTag(tag)
            context.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, min(at_once, len(tasks)))) as pool:
        # Threads see the caller's session and local properties, not each other's.
        futures = {name: pool.submit(inheritable_thread_target(spark)(tagged), name, task) for name, task in tasks.items()}
        if stop_on_failure:
            done, rest = wait(futures.values(), return_when=FIRST_EXCEPTION)
            if rest:
                stopped = True
                for future in rest:
                    future.cancel()
                spark.sparkContext.cancelJobsWithTag(tag)
        wait(futures.values())
    out = {n: RuntimeError(f"{n} was not started, as another task failed") if f.cancelled() else f.exception() or f.result() for n, f in futures.items()}
    failed = [x for x in out.values() if isinstance(x, Exception)]
    if failed and stop_on_failure:
        raise ExceptionGroup(f"{len(failed)} of {len(out)} tasks failed or were cancelled", failed)
    return out
