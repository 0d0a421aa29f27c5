"""Tables that are read or written at the same time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from threading import Event
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T, R = TypeVar("T"), TypeVar("R")

#: Tables at once. Cores that the last tasks of one leave free take up the next.
AT_ONCE = 4


def together(spark: SparkSession, work: Callable[[T], R], tables: Iterable[T], at_once: int = AT_ONCE) -> list[R]:
    """``work`` for each table, some at once, each from a thread of its own; results in the order given.

    Spark runs the jobs of all threads on the same cores. After an error no more tables are begun, and
    it is raised once those at hand are done.
    """
    failed = Event()

    def one(table: T) -> R | None:
        if failed.is_set():
            return None
        try:
            return work(table)
        except BaseException:
            failed.set()
            raise

    with ThreadPoolExecutor(at_once) as pool:
        # With the caller's job group and other local properties.
        begun = [pool.submit(inheritable_thread_target(spark)(one), t) for t in tables]
    return [b.result() for b in begun]
