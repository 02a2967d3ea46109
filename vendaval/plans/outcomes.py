"""What a job did to each table or view, and running a job over several of them."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Outcome:
    name: str
    rows: int | None = None
    watermark: str | None = None
    path: str | None = None
    error: Exception | None = None


def run_each(
    spark: SparkSession,
    job: Callable[[str], Outcome],
    names: Iterable[str],
    *,
    workers: int = 1,
) -> list[Outcome]:
    """One outcome per name, in order. A failure is reported and does not stop the others.

    With several workers the Spark jobs are submitted side by side, so the executors that
    one job's last tasks leave idle serve the next.
    """

    def attempt(name: str) -> Outcome:
        try:
            return job(name)
        except Exception as error:
            log.exception("%s failed", name)
            return Outcome(name, error=error)

    with ThreadPoolExecutor(max_workers=workers) as pool:
        return list(pool.map(inheritable_thread_target(spark)(attempt), names))
