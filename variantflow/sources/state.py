"""Stored variant tables."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantflow.schemas import STATE_SCHEMA, VARIANTS, slug_of, variant_state_schema
from variantflow.sources.published import read_published
from variantflow.sources.scratch import TEXTS


def read_if_exists(
    spark: SparkSession, path: str, schema: T.StructType | str, fmt: str = "parquet"
) -> DataFrame | None:
    """The table at ``path``, or None where nothing is stored."""
    try:
        return spark.read.schema(schema).format(fmt).load(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


_STORED = "description_original string, reply string"
#: folders of a stored state: the rows of all variants, and the slugs of the variants that have a table
_ROWS, _NAMES = "table=rows", "table=names"


def _table_path(root: str, variant: str) -> str:
    return f"{root.rstrip('/')}/slug={slug_of(variant)}"


def load_or_init(
    spark: SparkSession, root: str, variants: Sequence[str] = VARIANTS
) -> dict[str, DataFrame]:
    """The two-column table of each variant; if one is missing, all start empty.

    Reads what :func:`save_variant_tables` writes, tables that have a folder
    each, and the state that the rewrite job publishes, which names the source's
    text ``original_text``.
    """
    published = read_published(spark, root)
    if published is not None:
        found = {v: published.where(F.col("slug") == slug_of(v)).select("original_text", "reply") for v in variants}
        return {v: t.toDF(*variant_state_schema(v).fieldNames()) for v, t in found.items()}
    rows = read_if_exists(spark, f"{root.rstrip('/')}/{_ROWS}", f"slug string, {_STORED}")
    names = read_if_exists(spark, f"{root.rstrip('/')}/{_NAMES}", "slug string")
    named = {r.slug for r in names.collect()} if names is not None else set()
    found = {}
    for v in variants:
        own = read_if_exists(spark, _table_path(root, v), f"original_text string, {_STORED}")
        mine = None if rows is None else rows.where(F.col("slug") == slug_of(v)).select("description_original", "reply")
        if slug_of(v) not in named and (mine is None or mine.isEmpty()):
            mine = None
        elif mine is None:
            mine = spark.createDataFrame([], _STORED)
        if own is not None:
            text = F.coalesce("description_original", "original_text").alias("description_original")
            own = own.select(text, "reply")
            mine = own if mine is None else own.unionByName(mine)
        found[v] = mine
    if all(t is not None for t in found.values()):
        return {v: t.toDF(*variant_state_schema(v).fieldNames()) for v, t in found.items()}
    return {v: spark.createDataFrame([], variant_state_schema(v)) for v in variants}


def load_state(spark: SparkSession, path: str) -> DataFrame:
    """The long state table, or an empty one."""
    found = read_if_exists(spark, path, STATE_SCHEMA)
    return found if found is not None else spark.createDataFrame([], STATE_SCHEMA)


def save_variant_tables(
    state: DataFrame, root: str, variants: Sequence[str] = VARIANTS, mode: str = "errorifexists"
) -> None:
    """Tables for :func:`load_or_init`, all from one pass over the state.

    The rows of all variants lie in one folder as they come, so a text that
    follows itself for each of its variants is stored about once, not once for
    each.  The names of the tables are written last; a variant without rows has
    an empty table, which is not a missing one.
    """
    spark = state.sparkSession
    rows = state.select(
        F.replace("variant", F.lit(" "), F.lit("_")).alias("slug"),
        F.col("original_text").alias("description_original"),
        "reply",
        F.lit(_ROWS.partition("=")[2]).alias("table"),
    )
    write_routed(rows, root, by="table", mode=mode)
    names = spark.createDataFrame([(slug_of(v),) for v in variants], "slug string").coalesce(1)
    names.write.mode("append").parquet(f"{root.rstrip('/')}/{_NAMES}")


#: files that a task of a routed write keeps open, and the bytes of a row group of each
OPEN_FILES, ROW_GROUP = 8, 32 << 20


@contextmanager
def files_kept_open(spark: SparkSession, files: int = OPEN_FILES) -> Iterator[None]:
    """Tasks write at least so many folders at once, instead of sorting (and spilling) their rows by folder."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, str(max(files, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def write_routed(
    df: DataFrame, path: str, by: str = "slug", mode: str = "errorifexists", fmt: str = "parquet"
) -> None:
    """One directory for each variant from one pass over the long table.

    The rows are not sorted by directory unless a task meets more than ``OPEN_FILES`` of them.
    """
    writer = df.write.mode(mode).format(fmt).partitionBy(by)
    if fmt == "parquet":
        writer = writer.options(**TEXTS).option("parquet.block.size", ROW_GROUP)
    with files_kept_open(df.sparkSession):
        writer.save(path)


def read_routed(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """All variant directories as one table; a filter on the slug prunes them."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)
