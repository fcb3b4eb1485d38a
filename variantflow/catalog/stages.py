"""Inference, retry, incremental runs and the three stages."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantflow.catalog.base import (
    FAST,
    HEADS,
    HEADS_ONE_MISSING,
    SQL_BOTH_PASSES,
    SQL_FEATURES,
    SQL_HEADS,
    SQL_VARIANTS,
    STUB_SENDS,
    UNLOADED,
    descriptions,
    no_sleep,
    parallelism,
    query,
    sql_calls,
    sql_wide_scores,
    stub_service,
    table,
)
from variantflow.functions.text import artifact_path
from variantflow.operators.variants import fan_out
from variantflow.plans.generate import generation_requests, variant_manifest
from variantflow.plans.rewrite import call_service, retry_pass, rewrite
from variantflow.plans.score import score
from variantflow.schemas import SCORE_FIELDS, VARIANTS
from variantflow.sources.scratch import new_folder, written
from variantflow.streaming.progress import current_state, incremental_progress

STUB = {"policy": FAST, "sends": STUB_SENDS, "sleep": no_sleep}


def work_list(spark, sf_dir, variants=VARIANTS):
    """All (row, variant) pairs, spread over the cores before the fan-out."""
    docs = descriptions(spark, sf_dir).withColumnRenamed("text", "original_text")
    return fan_out(docs.repartition(parallelism(spark)), variants)


_RESULT = "row_idx, variant, original_text, pass, reply, attempts, total_delay_s, outcome"


@query(
    "batch_inference",
    f"WITH {SQL_VARIANTS}, calls AS ({sql_calls(1)}) SELECT {_RESULT} FROM calls",
)
def inferred(spark, sf_dir):
    return call_service(work_list(spark, sf_dir), stub_service, **STUB)


@query(
    "retry_pass",
    f"""WITH {SQL_VARIANTS}, first AS ({sql_calls(1)}), again AS ({sql_calls(2)})
        SELECT {_RESULT} FROM again
        WHERE (row_idx, variant) IN (SELECT (row_idx, variant) FROM first WHERE outcome = 'failed')""",
)
def retried(spark, sf_dir):
    first = written(call_service(work_list(spark, sf_dir), stub_service, **STUB), "retry-1")
    return retry_pass(first, stub_service, **STUB)


@query(
    "incremental_progress",
    f"WITH {SQL_VARIANTS}, calls AS ({sql_calls(1)}) SELECT {_RESULT} FROM calls",
)
def incremental(spark, sf_dir):
    folder = new_folder(spark, "progress")
    # a pattern, so that the table may be one file or a folder of files
    source = f"{sf_dir}/documents.{{parquet}}"
    cores = parallelism(spark)

    def work(batch):
        rows = batch.select(F.col("doc_id").alias("row_idx"), F.col("text").alias("original_text"))
        return call_service(fan_out(rows.repartition(cores)), stub_service, **STUB)

    run = incremental_progress(
        spark,
        source,
        table(spark, sf_dir, "documents").schema,
        work,
        f"{folder}/log",
        f"{folder}/checkpoint",
        max_files=100,
    )
    run.awaitTermination()
    return current_state(spark, f"{folder}/log")


_WIDE = ", ".join(
    f"max(reply) FILTER (WHERE slug = '{s}') AS description_{s}"
    for s in ("positive", "very_positive", "negative", "very_negative")
)


def rewritten(spark, sf_dir):
    return rewrite(
        descriptions(spark, sf_dir),
        stub_service,
        text="text",
        spread_to=parallelism(spark),
        **STUB,
    )


@query(
    "rewrite_stage",
    f"""WITH {SQL_BOTH_PASSES}
        SELECT row_idx, {_WIDE} FROM final WHERE outcome = 'ok' GROUP BY row_idx""",
)
def rewrite_stage(spark, sf_dir):
    return rewritten(spark, sf_dir).wide()


@query(
    "generate_stage",
    f"""WITH {SQL_VARIANTS},
        rows AS (SELECT doc_id AS row_idx, text, lang, source, n_chars, variant, slug,
                        '[' || variant || '] ' || text AS reply
                 FROM documents CROSS JOIN variants)
        SELECT *, 'User: ' || reply || chr(10) || chr(10) || 'Assistant:<begin_of_image>' AS prompt,
               'out/' || slug || '/img_small_' || row_idx || '.jpg' AS generated_filename
        FROM rows""",
)
def generate_stage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").withColumnRenamed("doc_id", "row_idx")
    manifest = variant_manifest(docs, "out")
    told = F.concat(F.lit("["), F.col("variant"), F.lit("] "), F.col("text"))
    return generation_requests(manifest.withColumn("reply", told), "out", "<begin_of_image>")


def features(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("row_idx"), F.col("embedding").alias("features")
    )


def stored_artifacts(spark, sf_dir, directory="out"):
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_idx"))
    path = artifact_path(directory, F.col("slug"), F.col("row_idx"))
    return fan_out(labels).select(path.alias("path"))


def rounded(df):
    return df.select("row_idx", "variant", *[F.round(c, 6).alias(c) for c in SCORE_FIELDS])


@query(
    "score_stage",
    f"""WITH {SQL_VARIANTS}, {SQL_HEADS}, {SQL_FEATURES},
        s AS (SELECT d.doc_id AS row_idx, variant, h,
                     CASE WHEN l.doc_id IS NOT NULL
                          THEN round((list_dot_product(f, w) + b) * scale, 6) END AS score
              FROM documents d CROSS JOIN variants CROSS JOIN heads
                   LEFT JOIN labels l ON l.doc_id = d.doc_id
                   LEFT JOIN features ON vec_id = d.doc_id)
        SELECT row_idx, variant, {sql_wide_scores('score', (UNLOADED,))}
        FROM s GROUP BY row_idx, variant""",
)
def score_stage(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"))
    rows = variant_manifest(docs, "out")
    manifest = stored_artifacts(spark, sf_dir)
    return rounded(
        score(
            rows.select("row_idx", "variant", "generated_filename"),
            features(spark, sf_dir),
            HEADS_ONE_MISSING,
            feature_key=["row_idx"],
            manifest=manifest,
        )
    )


@query(
    "scored_dataset",
    f"""WITH {SQL_BOTH_PASSES}, {SQL_HEADS}, {SQL_FEATURES},
        s AS (SELECT r.row_idx, variant, h,
                     'User: ' || reply || chr(10) || chr(10) || 'Assistant:<begin_of_image>' AS prompt,
                     'out/' || slug || '/img_small_' || r.row_idx || '.jpg' AS generated_filename,
                     CASE WHEN l.doc_id IS NOT NULL
                          THEN round((list_dot_product(f, w) + b) * scale, 6) END AS score
              FROM final r CROSS JOIN heads
                   LEFT JOIN labels l ON l.doc_id = r.row_idx
                   LEFT JOIN features ON vec_id = r.row_idx
              WHERE r.outcome = 'ok')
        SELECT row_idx, variant, any_value(prompt) AS prompt,
               any_value(generated_filename) AS generated_filename, {sql_wide_scores('score')}
        FROM s GROUP BY row_idx, variant""",
)
def scored_dataset(spark, sf_dir):
    """All three stages: rewrite with retry, prompts and paths, scores."""
    slug = F.replace("variant", F.lit(" "), F.lit("_"))
    state = rewritten(spark, sf_dir).state.withColumn("slug", slug)
    rows = generation_requests(state, "out", "<begin_of_image>")
    manifest = stored_artifacts(spark, sf_dir)
    scored = score(
        rows, features(spark, sf_dir), HEADS, feature_key=["row_idx"], manifest=manifest
    )
    return scored.select(
        "row_idx",
        "variant",
        "prompt",
        "generated_filename",
        *[F.round(c, 6).alias(c) for c in SCORE_FIELDS],
    )
