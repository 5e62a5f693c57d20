"""Independent fits side by side in one session."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Generic, TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

T = TypeVar("T")


@dataclass(frozen=True)
class Outcome(Generic[T]):
    """What a piece of work gave, or the error that ended it."""

    value: T | None
    error: Exception | None


def side_by_side(spark: SparkSession, work: Mapping[str, Callable[[], T]], at_once: int = 3) -> dict[str, Outcome[T]]:
    """Run named pieces of work, at most ``at_once`` at a time, each in a scheduler pool of its own.

    With ``spark.scheduler.mode=FAIR`` the pools share the executors evenly; otherwise jobs queue in order and fill free
    slots. A piece that fails ends alone: its error is its outcome, and the others go on.
    """
    def run(name: str) -> Outcome[T]:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        try:
            return Outcome(work[name](), None)
        except Exception as error:  # noqa: BLE001  (any failure of a fit is its outcome)
            return Outcome(None, error)
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        # Each piece has a thread that inherits the caller's job properties.
        waiting = {name: pool.submit(inheritable_thread_target(spark)(run), name) for name in work}
        return {name: future.result() for name, future in waiting.items()}
