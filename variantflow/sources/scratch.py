"""Shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession


def qualified(spark: SparkSession, folder: str) -> str:
    """A folder with its store: without one it is in the session's default, also for what tasks write by themselves."""
    if urlparse(folder).scheme:
        return folder
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(path).toString()


def scratch_root(spark: SparkSession) -> str:
    """The cluster's checkpoint folder.

    ``spark.checkpoint.dir`` names a folder that every executor reaches.  Only a
    local session without one gets a folder of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return qualified(spark, root).rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="variantflow-"))
    return context.getCheckpointDir().rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """Path of a new, unused folder under the shared folder."""
    return f"{scratch_root(spark)}/variantflow/{label}-{uuid.uuid4().hex}"


#: for tables of texts, which take about a third less room so than in Spark's default
TEXTS = {"compression": "zstd"}


def written(df: DataFrame, label: str = "table", path: str | None = None, **options: str) -> DataFrame:
    """Write ``df`` once and return the table read back; ``options`` are those of the Parquet writer.

    Cuts the lineage: later stages, retries and lost executors read files
    instead of running ``df`` again.
    """
    spark = df.sparkSession
    target = path or new_folder(spark, label)
    df.write.mode("overwrite").options(**options).parquet(target)
    return spark.read.schema(df.schema).parquet(target)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries planned inside drop their shuffle files as they end, not when the driver next collects garbage.

    One that runs twice shuffles again: write what is read again.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)
