"""The three stages as jobs from files to files."""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from variantflow.operators.counters import run_counters
from variantflow.operators.inference import Client, RetryPolicy, http_client
from variantflow.operators.keyed import text_id
from variantflow.operators.replies import dead_letter
from variantflow.operators.scoring import Head, export_names, heads_from_weights
from variantflow.operators.variants import assemble_wide, fan_out
from variantflow.plans.generate import generation_requests, variant_manifest
from variantflow.plans.rewrite import Rewritten, call_service, retry_pass, rewrite
from variantflow.plans.score import score
from variantflow.schemas import OUTCOMES, SCORE_COLUMNS, VARIANTS, slug_of
from variantflow.sources.artifacts import image_scan
from variantflow.sources.csv import csv_export, csv_scan, encoding_fallback_scan, numbered, same_header
from variantflow.sources.published import BUCKETS, bucket_of, current_version, publish_tables, read_published
from variantflow.sources.scratch import written
from variantflow.sources.state import read_if_exists, write_routed
from variantflow.streaming.progress import (
    current_outcomes,
    current_pairs,
    current_state,
    incremental_progress,
    log_folders,
    retry_failed,
)


#: rows whose calls a run that stops may lose
SLICE_ROWS = 100_000
#: the file that a stored row comes from
FILE = "_source_file"


def is_csv(path: str) -> bool:
    return path.rstrip("/").endswith(".csv")


def read_rows(spark: SparkSession, path: str, key: str = "row_idx") -> DataFrame:
    """A CSV, Parquet or published table with a row key; CSV rows without one are numbered."""
    if not is_csv(path):
        found = read_published(spark, path)
        return spark.read.parquet(path) if found is None else found
    rows = csv_scan(spark, path)
    return rows if key in rows.columns else numbered(csv_scan(spark, path, rows.schema, position=True), key)


def client_of(name: str) -> Callable[[], Client]:
    """``http(s)://...`` for a JSON service, else ``package.module:factory``."""
    if name.startswith(("http://", "https://")):
        return http_client(name)
    module, _, attribute = name.partition(":")
    return getattr(importlib.import_module(module), attribute)


def read_heads(path: str, spark: SparkSession) -> list[Head]:
    """Registry from a small JSON file ``{score: {"w": [...], "b": 0.0}}``."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    found = {name: (h["w"], h.get("b", 0.0)) for name, h in json.loads(text).items() if h}
    return heads_from_weights(found)


def rewrite_job(
    spark: SparkSession,
    source: str,
    out: str,
    client_factory: Callable[[], Client],
    *,
    key: str = "row_idx",
    text: str = "Description",
    redo: bool = False,
    spread_to: int | None = None,
    slice_rows: int | None = SLICE_ROWS,
    policy: RetryPolicy = RetryPolicy(),
    **options,
) -> DataFrame:
    """Rewrite what is not finished yet; returns the counters of the state.

    ``<out>/log`` grows with each slice of ``slice_rows`` rows, so a run that
    stops repeats only its open slice when it is started again.  ``<out>/wide``
    (the source's columns and one for each variant), ``<out>/state`` (one folder
    for each variant) and ``<out>/dead`` are published together as a new version:
    read them by :func:`~variantflow.sources.published.read_published`.
    ``<out>-runs`` gets the run's totals and seconds.
    """
    began = time.monotonic()
    log = f"{out}/log"
    rows = read_rows(spark, source, key)
    rows = rows.withColumn(key, F.col(key).cast("long"))
    finished = current_outcomes(spark, log).filter(F.col("outcome") != "failed")
    results = rewrite(
        rows,
        client_factory,
        key=key,
        text=text,
        state=finished,
        redo=redo,
        spread_to=spread_to,
        log=log,
        slice_rows=slice_rows,
        policy=policy,
        **options,
    )
    counters = publish(spark, rows, out, key, text)
    record_rewrite(results, rows.count(), out, began)
    return counters


def record_rewrite(results: Rewritten, n_rows: int, out: str, began: float) -> DataFrame:
    """Append the totals of a rewrite run to ``<out>-runs``: rows, calls, final outcomes, seconds."""
    spark = results.first.sparkSession
    called = results.attempts.agg(F.count_if(F.col("attempts") > 0)).first()[0]
    ends = {r["outcome"]: r["n"] for r in results.final.groupBy("outcome").agg(F.count("*").alias("n")).collect()}
    totals = {"rows": n_rows, "calls": called, **{o: ends.get(o, 0) for o in OUTCOMES}}
    return recorded(spark, totals, out, began)


def recorded(spark: SparkSession, totals: dict[str, int], out: str, began: float) -> DataFrame:
    """A run's totals and seconds, appended to ``<out>-runs``."""
    found = {**totals, "seconds": round(time.monotonic() - began, 3)}
    schema = ", ".join(f"{k} {'double' if k == 'seconds' else 'long'}" for k in found)
    run = spark.createDataFrame([tuple(found.values())], schema)
    run.write.mode("append").json(f"{out.rstrip('/').removesuffix('.csv')}-runs")
    return run


def incremental_rewrite_job(
    spark: SparkSession,
    source: str,
    out: str,
    client_factory: Callable[[], Client],
    *,
    key: str = "row_idx",
    text: str = "Description",
    max_files: int | None = None,
    fmt: str | None = None,
    schema: T.StructType | None = None,
    buckets: int = BUCKETS,
    policy: RetryPolicy = RetryPolicy(),
    **options,
) -> DataFrame:
    """:func:`rewrite_job` of a folder that grows: new files only; returns the counters of the state.

    Files are Parquet, or CSV with ``fmt="csv"`` or a source that ends so.  CSV rows without
    the key get their numbers when their file is first seen and keep them in ``<out>/rows``,
    see :func:`csv_rows`.  Only buckets of keys that got new results are published again.
    """
    calls = {"policy": policy, **options}
    fmt = fmt or ("csv" if is_csv(source) else "parquet")
    stored = f"{out}/rows"

    def work(batch: DataFrame) -> DataFrame:
        rows = batch.select(F.col(key).cast("long").alias("row_idx"), F.col(text).alias("original_text"))
        return call_service(fan_out(rows), client_factory, **calls)

    if fmt == "csv":
        known, taken = None, partial(csv_rows, stored=stored, key=key, schema=schema)
    else:
        known, taken = schema or spark.read.parquet(source).schema, None
    run = incremental_progress(
        spark, source, known, work, f"{out}/log", f"{out}/checkpoint", max_files=max_files, fmt=fmt, rows_of=taken
    )
    run.awaitTermination()
    retry_failed(spark, f"{out}/log", lambda state: retry_pass(state, client_factory, **calls))
    rows = spark.read.schema(known).parquet(source) if fmt != "csv" else spark.read.parquet(stored).drop("run", "batch", FILE)
    return publish(spark, rows, out, key, text, grown=True, buckets=buckets)


def csv_rows(files: DataFrame, place: str, stored: str, key: str, schema: T.StructType | None = None) -> DataFrame:
    """Rows of new CSV files (``path``), written to ``<stored>/<place>`` with a key that they keep.

    Rows without the key are numbered in file order, after all that are stored.  A place that is
    written again gets the same numbers, and files that another place holds, as after a lost checkpoint,
    are left out.  Types are those of ``schema``, or of what is stored, or inferred from the first files;
    a file with other columns raises, and so does a value that is none of its type.
    """
    spark = files.sparkSession
    # a stream lists its new files on the driver anyway
    names = sorted(r["path"] for r in files.distinct().collect())
    others = None
    if read_if_exists(spark, stored, "row_idx long") is not None:
        others = spark.read.parquet(stored)
        others = others.where(F.concat_ws("/", F.concat(F.lit("run="), "run"), F.concat(F.lit("batch="), "batch")) != place)
        names = sorted(set(names) - {r[FILE] for r in others.where(F.col(FILE).isin(names)).select(FILE).distinct().collect()})
        if not names:
            return others.drop("run", "batch", FILE).limit(0)
    kept = None if others is None else [f for f in others.schema.fields if f.name not in ("run", "batch", FILE)]
    for n in names:
        if set(n) & set("*?[]{}\\"):
            raise ValueError(f"the name of {n} would be read as a pattern")
    columns = same_header(spark, names)
    numbered_here = key not in columns
    if schema is None and kept:
        schema = T.StructType([f for f in kept if f.name != key or not numbered_here])
    if schema is not None and columns != schema.fieldNames():
        raise ValueError(f"columns of new files, {', '.join(columns)}, are not {', '.join(schema.fieldNames())}")
    rows = csv_scan(spark, names, schema, position=True)
    # the name as the stream gives it
    named = rows.withColumn(FILE, F.url_decode(F.replace("_file", F.lit("+"), F.lit("%2B"))))
    if numbered_here:
        last = others.agg(F.max(key)).first()[0] if others is not None else None
        first = 0 if last is None else last + 1
        named = numbered(named, key).withColumn(key, F.col(key) + F.lit(first).cast("long"))
    named = named.drop("_file", "_block", "_pos").withColumn(key, F.col(key).cast("long"))
    return written(named, path=f"{stored}/{place}").drop(FILE)


def publish(
    spark: SparkSession,
    rows: DataFrame,
    out: str,
    key: str,
    text: str = "Description",
    *,
    grown: bool = False,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Publish wide table, state and dead letters from the log as one version; returns the state's counters.

    A row has the replies to its own text, also where it shares its key.  With
    ``grown``, rows have only been added since the last version, and all new ones are in
    the log: buckets without new results stay as they are.
    """
    log, last = f"{out}/log", current_version(spark, out)
    folders = log_folders(spark, log).withColumn("bucket", bucket_of(F.col("row_idx"), buckets))
    known = last.note.get("folders", []) if last else []
    parts = folders.groupBy("folder").agg(F.collect_set("bucket").alias("buckets")).collect()
    touched = None
    if grown and last and last.buckets == buckets and last.note.get("columns") == rows.columns:
        touched = {b for r in parts if r["folder"] not in known for b in r["buckets"]}

    def mine(c):
        return None if touched is None else bucket_of(c, buckets).isin(sorted(touched))

    named = rows.withColumn("_text_id", text_id(F.col(text)))
    now = named.select(F.col(key).cast("long").alias("row_idx"), F.col("_text_id").alias("text_id"))
    counters = run_counters(current_pairs(spark, log, source=now))
    if touched is not None:
        named, now = named.where(mine(F.col(key))), now.where(mine(F.col("row_idx")))
    state = current_state(spark, log, source=now, identified=True, where=mine(F.col("row_idx")))
    # three tables are made of it
    state = written(state, "published-state")
    replies = assemble_wide(state.filter(F.col("outcome") == "ok"), ["row_idx", "text_id"])
    same = named[key].eqNullSafe(replies["row_idx"]) & (named["_text_id"] == replies["text_id"])
    texts = [replies[c] for c in replies.columns if c not in ("row_idx", "text_id")]
    wide = named.join(replies, same, "left").select(*[named[c] for c in rows.columns], *texts)
    state = state.drop("text_id")
    ok = state.filter(F.col("outcome") == "ok").withColumn("slug", F.replace("variant", F.lit(" "), F.lit("_")))
    publish_tables(
        spark,
        out,
        {"wide": (wide, ()), "state": (ok, ("slug",)), "dead": (dead_letter(state), ())},
        {"wide": key, "state": "row_idx", "dead": "row_idx"},
        touched=touched,
        buckets=buckets,
        note={"folders": sorted(r["folder"] for r in parts), "columns": rows.columns},
    )
    return counters


def generate_job(
    spark: SparkSession,
    source: str,
    out: str,
    artifacts: str,
    *,
    key: str = "row_idx",
    start_tag: str = "<begin_of_image>",
) -> DataFrame:
    """Manifest of each variant: the wide table with ``reply``, ``prompt`` and ``generated_filename``.

    ``reply`` is the variant's own text; without one there is no prompt.
    Returns the run's totals.
    """
    began = time.monotonic()
    rows = read_rows(spark, source, key).withColumnRenamed(key, "row_idx")
    manifest = variant_manifest(rows, artifacts)
    own = [
        F.when(F.col("variant") == v, F.col(f"description_{slug_of(v)}"))
        for v in VARIANTS
        if f"description_{slug_of(v)}" in rows.columns
    ]
    text = F.coalesce(*own) if own else F.lit(None).cast("string")
    made = generation_requests(manifest.withColumn("reply", text), artifacts, start_tag)
    made = made.withColumn("prompt", F.when(F.col("reply").isNotNull(), F.col("prompt")))
    return totals_of(spark, made, out, began, F.count("prompt").alias("prompts"))


def read_manifest(spark: SparkSession, source: str) -> DataFrame:
    """The variant tables of :func:`generate_job` as one, from Parquet or from CSV in either encoding."""
    if not is_csv(source):
        return spark.read.parquet(source)
    rows = encoding_fallback_scan(spark, source)
    if "variant" not in rows.columns and "slug" in rows.columns:
        rows = rows.withColumn("variant", F.replace("slug", F.lit("_"), F.lit(" ")))
    return rows.withColumn("row_idx", F.col("row_idx").cast("long"))


def totals_of(spark: SparkSession, df: DataFrame, out: str, began: float, *totals) -> DataFrame:
    """Write a table and its run's totals: rows and what is counted, seen as they are written, and seconds."""
    watch = Observation("run")
    write_table(df.observe(watch, F.count(F.lit(1)).alias("rows"), *totals), out)
    return recorded(spark, watch.get, out, began)


def score_job(
    spark: SparkSession,
    source: str,
    out: str,
    features: str,
    heads: list[Head],
    *,
    feature_key: tuple[str, ...] = ("row_idx", "variant"),
    images: str | None = None,
) -> DataFrame:
    """Manifests with one column for each score, under the published names; returns the run's totals.

    With a folder of ``images`` the files are read, and one that cannot be read
    has no scores; without it, a file has to exist.
    """
    began = time.monotonic()
    rows = read_manifest(spark, source)
    vectors = spark.read.parquet(features)
    manifest = None
    if images:
        manifest = image_scan(spark, images).select("path", F.col("height").isNotNull().alias("readable"))
    scored = score(rows, vectors, heads, feature_key=feature_key, manifest=manifest, listing=bool(images))
    some = F.count(f"`{SCORE_COLUMNS[0]}`").alias("scored")
    return totals_of(spark, export_names(scored), out, began, some)


def write_table(df: DataFrame, out: str) -> None:
    """One folder for each variant: CSV for a ``.csv`` target, else Parquet."""
    if is_csv(out):
        csv_export(df, out, partition_by=["slug"], mode="overwrite")
    else:
        write_routed(df, out, mode="overwrite")
