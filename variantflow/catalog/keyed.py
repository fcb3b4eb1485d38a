"""Row identity, keyed state, manifests and counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantflow.catalog.base import SQL_BOTH_PASSES, SQL_VARIANTS, descriptions, query, sql_calls, stub_replies, table
from variantflow.catalog.text import first_replies
from variantflow.functions.text import artifact_path
from variantflow.operators.counters import run_counters
from variantflow.operators.keyed import append_recovered, keyed_upsert, row_index
from variantflow.operators.manifest import align_results, manifest_join, missing_artifact_null
from variantflow.operators.replies import accept_reply, reply_outcome
from variantflow.operators.variants import assemble_wide, fan_out


@query(
    "row_index",
    """SELECT doc_id, lang, text, row_number() OVER (ORDER BY lang, doc_id) - 1 AS row_idx
       FROM documents""",
)
def indexed(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return row_index(docs, ["lang", "doc_id"]).select("doc_id", "lang", "text", "row_idx")


@query(
    "keyed_upsert",
    f"""WITH {SQL_VARIANTS},
        log AS (SELECT doc_id AS row_idx, variant, text AS reply, 1 AS pass
                FROM documents CROSS JOIN variants
                UNION ALL
                SELECT doc_id, variant, 'quality ' || quality, 2 FROM labels CROSS JOIN variants)
        SELECT row_idx, variant, reply, pass FROM log
        QUALIFY row_number() OVER (PARTITION BY row_idx, variant ORDER BY pass DESC) = 1""",
)
def upserted(spark, sf_dir):
    state = fan_out(descriptions(spark, sf_dir)).select(
        "row_idx", "variant", F.col("text").alias("reply"), F.lit(1).alias("pass")
    )
    updates = fan_out(table(spark, sf_dir, "labels")).select(
        F.col("doc_id").alias("row_idx"),
        "variant",
        F.concat(F.lit("quality "), F.col("quality").cast("string")).alias("reply"),
        F.lit(2).alias("pass"),
    )
    return keyed_upsert(state, updates)


@query(
    "append_recovered",
    f"""WITH {SQL_BOTH_PASSES}
        SELECT row_idx, variant, original_text, reply, pass FROM final WHERE outcome = 'ok'""",
)
def recovered(spark, sf_dir):
    columns = ["row_idx", "variant", "original_text", "reply", "pass"]
    first = first_replies(spark, sf_dir).select(*columns)
    # the second pass of the pairs that failed in the first
    failed = first_replies(spark, sf_dir).filter(F.col("reply").isNull())
    # joined before the fan-out: a text is shuffled once, not once for each variant
    failed = failed.groupBy("row_idx").agg(F.collect_set("variant").alias("failed"))
    docs = descriptions(spark, sf_dir).withColumnRenamed("text", "original_text").join(failed, "row_idx")
    pairs = fan_out(docs).filter(F.array_contains("failed", F.col("variant"))).drop("failed")
    return append_recovered(accept_reply(first), accept_reply(stub_replies(pairs, 2)))


@query(
    "assemble_wide",
    f"""WITH {SQL_VARIANTS}, calls AS ({sql_calls(1)})
        SELECT row_idx,
               max(reply) FILTER (WHERE slug = 'positive') AS description_positive,
               max(reply) FILTER (WHERE slug = 'very_positive') AS description_very_positive,
               max(reply) FILTER (WHERE slug = 'negative') AS description_negative,
               max(reply) FILTER (WHERE slug = 'very_negative') AS description_very_negative
        FROM calls WHERE outcome = 'ok' GROUP BY row_idx""",
)
def assembled(spark, sf_dir):
    return assemble_wide(accept_reply(first_replies(spark, sf_dir)))


@query(
    "run_counters",
    f"""WITH {SQL_VARIANTS}, calls AS ({sql_calls(1)})
        SELECT variant, outcome, count(*) AS n_rows FROM calls GROUP BY variant, outcome""",
)
def counted(spark, sf_dir):
    outcome = reply_outcome(F.col("original_text"), F.col("reply"))
    return run_counters(first_replies(spark, sf_dir).withColumn("outcome", outcome))


_PATHS_SQL = f"""{SQL_VARIANTS},
        wanted AS (SELECT doc_id AS row_idx, variant,
                          CASE WHEN lang <> 'de'
                               THEN '/out/' || slug || '/img_small_' || doc_id || '.jpg' END
                            AS generated_filename
                   FROM documents CROSS JOIN variants)"""


def wanted_and_manifest(spark, sf_dir):
    """Paths of all pairs, none for one language, and a manifest of labelled rows."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"), "lang")
    path = artifact_path("/out", F.col("slug"), F.col("row_idx"))
    wanted = fan_out(docs).select(
        "row_idx", "variant", F.when(F.col("lang") != "de", path).alias("generated_filename")
    )
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_idx"), "quality")
    listed = artifact_path("file:/out", F.col("slug"), F.col("row_idx"))
    manifest = fan_out(labels).select(listed.alias("path"), "quality")
    return wanted, manifest


@query(
    "manifest_join",
    f"""WITH {_PATHS_SQL}
        SELECT row_idx, variant, generated_filename,
               l.doc_id IS NOT NULL AND generated_filename IS NOT NULL AS present
        FROM wanted LEFT JOIN labels l ON l.doc_id = row_idx""",
)
def joined(spark, sf_dir):
    wanted, manifest = wanted_and_manifest(spark, sf_dir)
    return manifest_join(wanted, manifest, salt=["row_idx", "variant"])


@query(
    "missing_artifact_null",
    f"""WITH {_PATHS_SQL}
        SELECT row_idx, variant,
               CASE WHEN generated_filename IS NOT NULL THEN quality::DOUBLE * 10 END AS score
        FROM wanted LEFT JOIN labels l ON l.doc_id = row_idx""",
)
def nulled(spark, sf_dir):
    wanted, manifest = wanted_and_manifest(spark, sf_dir)
    rows = manifest_join(wanted, manifest, salt=["row_idx", "variant"], carry=["quality"])
    score = missing_artifact_null(F.col("present"), F.col("quality").cast("double") * 10)
    return rows.select("row_idx", "variant", score.alias("score"))


@query(
    "result_alignment",
    f"""WITH {SQL_VARIANTS}
        SELECT d.doc_id AS row_idx, variant, text,
               'out/' || slug || '/img_small_' || d.doc_id || '.jpg' AS generated_filename
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id CROSS JOIN variants""",
)
def aligned(spark, sf_dir):
    rows = fan_out(descriptions(spark, sf_dir)).select("row_idx", "variant", "text")
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("row_idx"))
    path = artifact_path("out", F.col("slug"), F.col("row_idx"))
    results = fan_out(labels).select("row_idx", "variant", path.alias("generated_filename"))
    return align_results(rows, results)
