"""Registry of named queries and what they share.

The tables stand in for the real inputs: ``documents`` for descriptions,
``embeddings`` for image features, ``labels`` for the artifacts that exist,
``conversations`` for chat prompts.  ``doc_id`` and ``vec_id`` are row keys.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from variantflow.operators.inference import RetryPolicy
from variantflow.operators.scoring import heads_from_weights
from variantflow.schemas import SCORE_COLUMNS

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    """Register a query with the SQL that must give the same rows."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_idx, text) of every document."""
    return table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"), "text")


def parallelism(spark: SparkSession) -> int:
    return spark.sparkContext.defaultParallelism


# --- stand-in regressors ----------------------------------------------------
WIDTH = 64
UNLOADED = 5  # the head whose model is missing


def weights(missing: tuple[int, ...] = ()):
    found = {}
    for h, name in enumerate(SCORE_COLUMNS):
        w = [((h * 7 + i * 13) % 17 - 8) / 100 for i in range(WIDTH)]
        found[name] = None if h in missing else (w, h / 10)
    return found


HEADS = heads_from_weights(weights())
HEADS_ONE_MISSING = heads_from_weights(weights((UNLOADED,)))

SQL_VARIANTS = (
    "variants(variant, slug) AS (VALUES ('positive','positive'), ('very positive','very_positive'),"
    " ('negative','negative'), ('very negative','very_negative'))"
)

SQL_HEADS = (
    "heads AS (SELECT h, head, field, h::DOUBLE / 10 AS b,"
    " CASE WHEN h = 0 THEN 10.0::DOUBLE ELSE 1.0::DOUBLE END AS scale,"
    f" list_transform(range({WIDTH}), lambda i: ((h * 7 + i * 13) % 17 - 8)::DOUBLE / 100) AS w"
    " FROM (VALUES "
    + ", ".join(
        f"({h}, '{name}', '{name.lower().replace(' ', '_')}')"
        for h, name in enumerate(SCORE_COLUMNS)
    )
    + ") AS names(h, head, field))"
)

SQL_FEATURES = "features AS (SELECT vec_id, embedding::DOUBLE[] AS f FROM embeddings)"


def sql_wide_scores(score: str, missing: tuple[int, ...] = ()) -> str:
    """One column for each head from rows that have ``h`` and a score."""
    cells = []
    for h, name in enumerate(SCORE_COLUMNS):
        value = "NULL::DOUBLE" if h in missing else f"max({score}) FILTER (WHERE h = {h})"
        cells.append(f"{value} AS {name.lower().replace(' ', '_')}")
    return ", ".join(cells)


# --- stand-in text service --------------------------------------------------
FAST = RetryPolicy(pause_s=0.0)
STUB_SENDS = ("row_idx", "variant", "original_text")


def no_sleep(seconds: float) -> None:
    """Delays are counted, not waited for."""


def stub_service():
    """Client whose failures depend only on the key and the pass."""
    import hashlib

    def call(request: dict, attempt: int) -> tuple[int, str]:
        name = f"{request['row_idx']}:{request['variant']}:{request['pass']}"
        digest = hashlib.md5(name.encode()).hexdigest()
        failures = int(digest[:8], 16) * 8 >> 32
        if attempt <= failures:
            if attempt % 2:
                raise ConnectionError("stand-in transport failure")
            return 503, "busy"
        if int(digest[8:10], 16) < 13:
            return 200, ""
        return 200, f"[{request['variant']}] {request['original_text']}"

    return call


def stub_replies(df: DataFrame, pass_no: int = 1) -> DataFrame:
    """What the stand-in service answers, as columns; needs row_idx, variant, original_text."""
    digest = F.md5(F.concat_ws(":", F.col("row_idx").cast("string"), "variant", F.lit(str(pass_no))))
    failures = F.floor(
        F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0) * 8
    )
    silent = F.conv(F.substring(digest, 9, 2), 16, 10).cast("int") < 13
    told = F.concat(F.lit("["), F.col("variant"), F.lit("] "), F.col("original_text"))
    reply = F.when(failures < 5, F.when(silent, F.lit("")).otherwise(told))
    return df.withColumns({"pass": F.lit(pass_no), "reply": reply})


def sql_calls(pass_no: int, source: str = "documents CROSS JOIN variants") -> str:
    """Body of a CTE with the stand-in service's answers of one pass."""
    return f"""
      SELECT row_idx, variant, slug, original_text, {pass_no} AS pass,
             CASE WHEN fails >= 5 THEN NULL WHEN silent THEN ''
                  ELSE '[' || variant || '] ' || original_text END AS reply,
             least(fails + 1, 5)::INTEGER AS attempts,
             CASE WHEN fails < 5 THEN 2.0::DOUBLE * (pow(2, fails) - 1) ELSE 62.0::DOUBLE END
               AS total_delay_s,
             CASE WHEN fails >= 5 THEN 'failed' WHEN silent THEN 'empty' ELSE 'ok' END AS outcome
      FROM (SELECT *, floor(('0x' || substr(d, 1, 8))::BIGINT / 4294967296.0::DOUBLE * 8)::INTEGER
                        AS fails,
                   ('0x' || substr(d, 9, 2))::INTEGER < 13 AS silent
            FROM (SELECT doc_id AS row_idx, variant, slug, text AS original_text,
                         md5(doc_id || ':' || variant || ':{pass_no}') AS d
                  FROM {source}))"""


SQL_BOTH_PASSES = f"""{SQL_VARIANTS},
  first AS ({sql_calls(1)}),
  again AS ({sql_calls(2)}),
  final AS (SELECT * FROM first WHERE outcome <> 'failed'
            UNION ALL
            SELECT again.* FROM again JOIN first USING (row_idx, variant)
            WHERE first.outcome = 'failed')"""
