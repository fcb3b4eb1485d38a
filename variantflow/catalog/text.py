"""Projections, variant fan-out, prompts, replies."""

from __future__ import annotations

from pyspark.sql import functions as F

from variantflow.catalog.base import SQL_VARIANTS, descriptions, query, sql_calls, stub_replies, table
from variantflow.functions.text import (
    PLAIN_DIALECT,
    TAGGED_DIALECT,
    artifact_path,
    chat_messages,
    chat_render,
    prompt_template,
    request_payload_json,
)
from variantflow.operators.columns import add_or_replace_columns, optional_column, project_columns
from variantflow.operators.replies import accept_reply, classify_response, dead_letter
from variantflow.operators.variants import dispatch_by_variant, fan_out, union_variants
from variantflow.schemas import VARIANTS, slug_of


@query("project_columns", "SELECT doc_id AS row_idx, text AS description FROM documents")
def project(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return project_columns(docs, {"row_idx": "doc_id", "description": "text"})


@query(
    "optional_column",
    "SELECT doc_id, lang, CAST(NULL AS VARCHAR) AS generated_filename FROM documents",
)
def optional(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id", optional_column(docs, "lang"), optional_column(docs, "generated_filename")
    )


@query(
    "add_or_replace_columns",
    """SELECT doc_id, text, upper(lang) AS lang, source, length(text)::BIGINT AS n_chars,
              'out/img_small_' || doc_id || '.jpg' AS generated_filename FROM documents""",
)
def add_or_replace(spark, sf_dir):
    path = F.concat(F.lit("out/img_small_"), F.col("doc_id").cast("string"), F.lit(".jpg"))
    return add_or_replace_columns(
        table(spark, sf_dir, "documents"),
        {
            "lang": F.upper("lang"),
            "n_chars": F.length("text").cast("long"),
            "generated_filename": path,
        },
    )


@query(
    "variant_fanout",
    f"""WITH {SQL_VARIANTS} SELECT doc_id AS row_idx, text, variant, slug
        FROM documents CROSS JOIN variants""",
)
def variant_fanout(spark, sf_dir):
    return fan_out(descriptions(spark, sf_dir))


_STATES = " UNION ALL ".join(
    "SELECT doc_id AS row_idx, text AS description_original, "
    + ", ".join(
        (f"'[{v}] ' || text" if u == v else "CAST(NULL AS VARCHAR)") + f" AS description_{slug_of(u)}"
        for u in VARIANTS
    )
    + f", '{v}' AS variant, '{slug_of(v)}' AS slug FROM documents"
    for v in VARIANTS
)


@query("variant_union", _STATES)
def variant_union(spark, sf_dir):
    docs = descriptions(spark, sf_dir)
    tables = {
        v: docs.select(
            "row_idx",
            F.col("text").alias("description_original"),
            F.concat(F.lit(f"[{v}] "), "text").alias(f"description_{slug_of(v)}"),
        )
        for v in VARIANTS
    }
    return union_variants(tables)


# --- fixed values: the prompt -------------------------------------------
_PROMPT_SQL = (
    "'Rewrite the following text to have a tone that is ' || variant || ':' || chr(10) || chr(10)"
    " || text || '. Be faithful to the original text. It must have the same amount of tokens.'"
)
_SEED, _MODEL = 42, "mistral"
# --- end of fixed values ------------------------------------------------


@query(
    "prompt_template",
    f"""WITH {SQL_VARIANTS} SELECT doc_id AS row_idx, variant, {_PROMPT_SQL} AS prompt
        FROM documents CROSS JOIN variants""",
)
def prompts(spark, sf_dir):
    rows = fan_out(descriptions(spark, sf_dir))
    prompt = prompt_template(F.col("text"), F.col("variant"))
    return rows.select("row_idx", "variant", prompt.alias("prompt"))


@query(
    "request_payload_json",
    f"""WITH {SQL_VARIANTS} SELECT doc_id AS row_idx, variant,
          to_json({{'messages': [{{'role': 'user', 'content': {_PROMPT_SQL}}}],
                    'seed': {_SEED}, 'model': '{_MODEL}'}})::VARCHAR AS payload
        FROM documents CROSS JOIN variants""",
)
def payloads(spark, sf_dir):
    rows = fan_out(descriptions(spark, sf_dir))
    prompt = prompt_template(F.col("text"), F.col("variant"))
    return rows.select("row_idx", "variant", request_payload_json(prompt).alias("payload"))


@query(
    "chat_render",
    """SELECT conv_id, turn,
              'User: ' || text || chr(10) || chr(10) || 'Assistant:<begin_of_image>' AS plain_prompt,
              '<|User|>: ' || text || chr(10) || chr(10) || '<|Assistant|>:<image_gen>'
                AS tagged_prompt
       FROM conversations""",
)
def chat(spark, sf_dir):
    def rendered(dialect, tag):
        return chat_render(chat_messages(F.col("text"), dialect), tag, dialect)

    return table(spark, sf_dir, "conversations").select(
        "conv_id",
        "turn",
        rendered(PLAIN_DIALECT, "<begin_of_image>").alias("plain_prompt"),
        rendered(TAGGED_DIALECT, "<image_gen>").alias("tagged_prompt"),
    )


@query(
    "artifact_path",
    f"""WITH {SQL_VARIANTS} SELECT doc_id AS row_idx, variant,
          'out/' || slug || '/img_small_' || doc_id || '.jpg' AS generated_filename
        FROM documents CROSS JOIN variants""",
)
def paths(spark, sf_dir):
    rows = fan_out(descriptions(spark, sf_dir))
    path = artifact_path("out", F.col("slug"), F.col("row_idx"))
    return rows.select("row_idx", "variant", path.alias("generated_filename"))


def first_replies(spark, sf_dir, pass_no: int = 1):
    rows = fan_out(descriptions(spark, sf_dir).withColumnRenamed("text", "original_text"))
    return stub_replies(rows, pass_no)


@query(
    "accept_reply",
    f"""WITH {SQL_VARIANTS}, calls AS ({sql_calls(1)})
        SELECT row_idx, variant, reply FROM calls WHERE reply <> ''""",
)
def accepted(spark, sf_dir):
    return accept_reply(first_replies(spark, sf_dir)).select("row_idx", "variant", "reply")


@query(
    "dead_letter",
    f"""WITH {SQL_VARIANTS}, calls AS ({sql_calls(1)})
        SELECT row_idx, variant, original_text, 'no_reply' AS reason, attempts
        FROM calls WHERE reply IS NULL""",
)
def dead(spark, sf_dir):
    return dead_letter(first_replies(spark, sf_dir).withColumn("attempts", F.lit(5)))


@query(
    "dispatch_by_variant",
    f"""WITH {SQL_VARIANTS} SELECT doc_id AS row_idx, variant, 'dataset_' || slug AS target
        FROM documents CROSS JOIN variants""",
)
def dispatched(spark, sf_dir):
    # a tone that no table takes is left out
    rows = fan_out(descriptions(spark, sf_dir), (*VARIANTS, "neutral"))
    return dispatch_by_variant(rows).select("row_idx", "variant", "target")


@query(
    "classify_response",
    """WITH stub AS (
         SELECT conv_id, turn, text, ('0x' || substr(md5(conv_id || ':' || turn), 1, 2))::INTEGER % 5 AS k
         FROM conversations)
       SELECT conv_id, turn,
              CASE k WHEN 0 THEN 'ok' WHEN 4 THEN 'fatal' ELSE 'retry' END AS outcome,
              CASE WHEN k = 0 THEN text END AS reply
       FROM stub""",
)
def responses(spark, sf_dir):
    digest = F.md5(F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    kind = F.conv(F.substring(digest, 1, 2), 16, 10).cast("int") % 5
    stub = (
        table(spark, sf_dir, "conversations")
        .withColumn("k", kind)
        .withColumns(
            {
                "status": F.when(F.col("k") == 0, 200).when(F.col("k") == 1, 429).when(F.col("k") == 2, 500),
                "error": F.when(F.col("k") == 3, "request").when(F.col("k") == 4, "other"),
            }
        )
    )
    outcome = classify_response(F.col("status"), F.col("error"))
    return stub.select("conv_id", "turn", outcome.alias("outcome"), "text").select(
        "conv_id", "turn", "outcome", F.when(F.col("outcome") == "ok", F.col("text")).alias("reply")
    )
