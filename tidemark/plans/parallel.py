"""Independent steps as concurrent Spark jobs."""

from __future__ import annotations

import contextvars
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor, wait

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

WIDTH = 4       # steps at a time; their jobs share the cluster


def concurrently(spark: SparkSession, work: Mapping[str, Callable[[], object]], width: int = WIDTH) -> dict[str, object]:
    """Run independent pieces of work, each in a scheduler pool of its own name; returns their results.

    After a failure no further piece is started; those under way end, and the first
    failure (in the order given) is raised.  Pieces see the step open around this call.
    """
    stopped: list[str] = []

    def piece(name: str, fn: Callable[[], object]) -> object:
        if stopped:
            return None
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return fn()
        except BaseException:
            stopped.append(name)
            raise
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, width)) as pool:
        futures = {name: pool.submit(contextvars.copy_context().run, inheritable_thread_target(spark)(piece), name, fn)
                   for name, fn in work.items()}
        wait(futures.values())
    for future in futures.values():
        if future.exception() is not None:
            raise future.exception()
    return {name: future.result() for name, future in futures.items()}
