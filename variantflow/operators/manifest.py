"""Rows against the files that exist for them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantflow.functions.text import default_store, qualified_path
from variantflow.sources.scratch import written


def manifest_join(
    rows: DataFrame,
    manifest: DataFrame,
    path: str = "generated_filename",
    *,
    salt: Sequence[str] = ("row_idx",),
    files_path: str = "path",
    carry: Sequence[str] = (),
    distinct: bool = False,
    store: str | None = None,
) -> DataFrame:
    """Add ``present`` (and ``carry`` columns of the manifest); every row is kept.

    Rows with a NULL or blank path may be very many.  They get a key that no
    file has, spread by the ``salt`` columns, instead of one common hash value.
    A path that very many rows share is left to the adaptive skew join, which
    needs a manifest without an aggregation of its own: a listing has distinct
    paths already (``distinct=True``), any other table is reduced and written.

    Paths are compared with the store they are in; ``store`` is that of paths
    without a scheme, by default the session's own.
    """
    store = store or default_store(rows.sparkSession)
    given = F.col(path).isNotNull() & (F.col(path) != "")
    # the first letter keeps the two kinds of key apart
    spread = F.concat(F.lit("n"), F.xxhash64(*salt).cast("string"))
    left = rows.withColumn("_key", F.when(given, _path_key(path, store)).otherwise(spread))
    files = manifest.select(_path_key(files_path, store).alias("_key"), *carry)
    if not distinct:
        facts = [F.max(c).alias(c) for c in carry]
        reduced = files.groupBy("_key").agg(*facts) if facts else files.distinct()
        files = written(reduced, "manifest")
    files = files.withColumn("present", F.lit(True))
    joined = left.join(files, "_key", "left").drop("_key")
    return joined.withColumn("present", F.coalesce("present", F.lit(False)))


def _path_key(path: str, store: str) -> Column:
    return F.concat(F.lit("p"), qualified_path(F.col(path), store))


def missing_artifact_null(present: Column, score: Column) -> Column:
    """The score where the artifact exists, else NULL."""
    return F.when(present, score)


def align_results(
    rows: DataFrame, results: DataFrame, key: Sequence[str] = ("row_idx", "variant")
) -> DataFrame:
    """Attach results to their rows by key, never by position."""
    return rows.join(results, list(key))
