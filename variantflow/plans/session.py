"""Session settings for the jobs of this package."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # a second copy of a task would repeat its service calls
    "spark.speculation": "false",
    # four variant directories: keep a file open for each instead of sorting
    "spark.sql.maxConcurrentOutputFileWriters": "8",
    # texts go to the Python workers and back; the local TCP stack stalled
    # under gigabytes in both directions at once
    "spark.python.unix.domain.socket.enabled": "true",
    # long texts: bound a batch by bytes as well as by rows
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(64 << 20),
}


def build_session(name: str = "variantflow", **extra: str) -> SparkSession:
    """Session with the package's settings; cluster settings come from outside."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
