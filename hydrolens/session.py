"""Session settings the queries rely on."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Small jobs that run side by side.
JOBS = 8

RUNTIME_SETTINGS = {
    # Dates and hours of readings are UTC.
    "spark.sql.session.timeZone": "UTC",
    # The JVM does not compile methods above 8000 bytes of bytecode. A stage whose generated
    # loop would be longer runs faster when each operator generates its own, split code.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def together(spark: SparkSession, *jobs: Callable[[], object]) -> list:
    """Runs independent small jobs side by side; the first failure is raised when all have ended."""
    with ThreadPoolExecutor(JOBS) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(job)) for job in jobs]]
