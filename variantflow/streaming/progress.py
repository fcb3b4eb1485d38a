"""Incremental runs: process new input files, keep every finished reply."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from variantflow.operators.keyed import latest, text_id
from variantflow.schemas import STORED_LOG_SCHEMA
from variantflow.sources.scratch import TEXTS, written
from variantflow.sources.state import read_if_exists


#: where a stored result lies: a name of its file, and its row there
PLACE = ["_file", "_row"]
#: superseded results that are broadcast; more are joined by a shuffle of the log
BROADCAST_ROWS = 100_000


def logged(results: DataFrame) -> DataFrame:
    """Results as rows of the log, stamped with the time of this write."""
    now = F.lit(time.time_ns() // 1_000_000).cast("long")
    named = results.withColumns({"logged_at": now, "text_id": text_id(F.col("original_text"))})
    return named.select(*STORED_LOG_SCHEMA.fieldNames())


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a streaming query keeps in its checkpoint, for as long as the checkpoint lives."""
    found = spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()["value"]
    return json.loads(found)["id"]


def incremental_progress(
    spark: SparkSession,
    source: str,
    schema: T.StructType | None,
    work: Callable[[DataFrame], DataFrame],
    log: str,
    checkpoint: str,
    *,
    max_files: int | None = None,
    fmt: str = "parquet",
    rows_of: Callable[[DataFrame, str], DataFrame] | None = None,
) -> StreamingQuery:
    """Run ``work`` on each micro-batch of new files and append to the log.

    A micro-batch writes a folder of its own, so progress costs as much as its
    own rows however long the log is.  A repeated micro-batch replaces exactly
    its folder.  The checkpoint remembers finished files: a restart with the
    same one makes no call again.  Folders are named by the id in the checkpoint,
    so a new checkpoint at the same place starts new folders and replaces none.

    ``rows_of(files, place)`` turns (path) of a micro-batch's new files into its rows, for
    formats that a stream can't read as they are; ``place`` names the micro-batch.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        place = f"run={query_id(batch.sparkSession, checkpoint)}/batch={batch_id}"
        rows = rows_of(batch, place) if rows_of else batch
        logged(work(rows)).write.mode("overwrite").options(**TEXTS).parquet(f"{log}/{place}")

    # of files as they are
    listed = "path string, modificationTime timestamp, length long, content binary"
    stream = spark.readStream.schema(listed if rows_of else schema).format("binaryFile" if rows_of else fmt)
    if max_files:
        stream = stream.option("maxFilesPerTrigger", max_files)
    found = stream.load(source)
    # only the names of files are asked for: their content is not read
    found = found.select("path") if rows_of else found
    return (
        found.writeStream.foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def read_log(spark: SparkSession, log: str) -> DataFrame:
    """All stored results, also repeated ones, or an empty table."""
    return placed_log(spark, log).drop(*PLACE)


def placed_log(spark: SparkSession, log: str) -> DataFrame:
    """:func:`read_log` with the place of each row."""
    found = read_if_exists(spark, log, STORED_LOG_SCHEMA)
    if found is None:
        place = [F.lit(None).cast("long").alias(c) for c in PLACE]
        return spark.createDataFrame([], STORED_LOG_SCHEMA).select("*", *place)
    place = [F.xxhash64("_metadata.file_path"), F.col("_metadata.row_index")]
    return found.select(*STORED_LOG_SCHEMA.fieldNames(), *[c.alias(n) for c, n in zip(place, PLACE)])


def current_state(
    spark: SparkSession,
    log: str,
    key: Sequence[str] = ("row_idx", "variant"),
    source: DataFrame | None = None,
    identified: bool = False,
    where: Column | None = None,
) -> DataFrame:
    """Newest result of each key and text.

    An accepted reply beats a failed one of any run; then the later one wins.
    The winner is found without the texts, and all other results are left out by
    their places in the log's files: those are written first, and no text is
    shuffled unless there are more than ``BROADCAST_ROWS`` of them.  ``source``, (row_idx, text_id) of the rows as they
    are now, leaves out results of other texts that its keys had.  ``identified``
    keeps the column ``text_id``.  ``where`` reads a part of the log by its keys.
    """
    rows = placed_log(spark, log)
    if where is not None:
        rows = rows.where(where)
    held = _of_source(_newest(rows, [*key]), source)
    gone = rows.select(*PLACE).join(held.select(*PLACE), PLACE, "left_anti")
    gone = written(gone, "superseded-results")
    many = gone.count()
    if many:
        rows = rows.join(F.broadcast(gone) if many <= BROADCAST_ROWS else gone, PLACE, "left_anti")
    return rows.drop(*PLACE, "logged_at", *([] if identified else ["text_id"]))


def current_pairs(
    spark: SparkSession,
    log: str,
    key: Sequence[str] = ("row_idx", "variant"),
    source: DataFrame | None = None,
    where: Column | None = None,
) -> DataFrame:
    """:func:`current_outcomes` of the texts that :func:`current_state` keeps; reads no text of the log."""
    return _of_source(current_outcomes(spark, log, key, where), source)


def _of_source(narrow: DataFrame, source: DataFrame | None) -> DataFrame:
    """Results without those of other texts that the keys of ``source`` had."""
    if source is None:
        return narrow
    now = source.distinct()
    same = narrow["row_idx"].eqNullSafe(now["row_idx"])
    held = narrow.join(now, same & (narrow["text_id"] == now["text_id"]), "left_semi")
    keys = source.select("row_idx").distinct()
    gone = narrow.join(keys, narrow["row_idx"].eqNullSafe(keys["row_idx"]), "left_anti")
    return held.unionByName(gone)


def log_folders(spark: SparkSession, log: str) -> DataFrame:
    """(row_idx, folder) of all stored results: the folder ``run=.../batch=...`` that each was written to."""
    rows = read_if_exists(spark, log, STORED_LOG_SCHEMA)
    if rows is None:
        return spark.createDataFrame([], "row_idx long, folder string")
    folder = F.regexp_extract(F.col("_metadata.file_path"), r"/(run=[^/]*/batch=[^/]*)/[^/]*$", 1)
    return rows.select("row_idx", folder.alias("folder"))


def current_outcomes(
    spark: SparkSession,
    log: str,
    key: Sequence[str] = ("row_idx", "variant"),
    where: Column | None = None,
) -> DataFrame:
    """(key, text_id, pass, outcome, logged_at) of the newest result of each key and text; reads no text."""
    rows = read_log(spark, log)
    if where is not None:
        rows = rows.where(where)
    return _newest(rows, [*key])


def _newest(rows: DataFrame, key: list[str]) -> DataFrame:
    """Narrow columns of the newest result of each key and text, with its place where ``rows`` have it."""
    place = [c for c in PLACE if c in rows.columns]
    columns = [*key, "text_id", "pass", "outcome", "logged_at", *place]
    rows = rows.select(*columns).withColumn("_ok", F.col("outcome") == "ok")
    return latest(rows, [*key, "text_id"], ("_ok", "logged_at", "pass")).select(*columns)


def retry_failed(
    spark: SparkSession, log: str, call: Callable[[DataFrame], DataFrame]
) -> DataFrame:
    """Second pass over everything that is still without a reply; returns its results.

    ``call`` is :func:`variantflow.plans.rewrite.retry_pass` with its client.
    """
    target = f"{log}/run=retry-{uuid.uuid4().hex[:12]}/batch=2"
    return written(logged(call(current_state(spark, log))), path=target)


def compact(spark: SparkSession, log: str, target: str) -> DataFrame:
    """Write the current state to a new folder; the log stays as it is."""
    state = current_state(spark, log)
    state.write.mode("errorifexists").parquet(target)
    return spark.read.schema(state.schema).parquet(target)
