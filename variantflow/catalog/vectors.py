"""Array operators and scoring."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from variantflow.catalog.base import (
    HEADS,
    HEADS_ONE_MISSING,
    SQL_FEATURES,
    SQL_HEADS,
    UNLOADED,
    query,
    sql_wide_scores,
    table,
)
from variantflow.functions.arrays import (
    channels_last,
    dequantize,
    doubles,
    grid_cells,
    guided_combine,
    mask_pair,
    weighted_draw_batch,
)
from variantflow.functions.text import key_uniform
from variantflow.operators.scoring import (
    conditional_rescale,
    head_lookup_default,
    head_rows,
    score_long,
    scores_map,
    scores_to_wide,
)
from variantflow.schemas import SCORE_FIELDS


def vectors(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", doubles(F.col("embedding")).alias("features")
    )


def image_features(spark, sf_dir):
    """The stored single precision numbers; scoring widens them in its tasks."""
    return table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("features"))


def halves():
    """First half of the vector as conditional, second as unconditional logits."""
    f = F.col("features")
    return F.slice(f, 1, 32), F.slice(f, 33, 32)


_GUIDED_SQL = "list_transform(range(1, 33), lambda i: f[i + 32] + 5.0::DOUBLE * (f[i] - f[i + 32]))"


@query(
    "guided_combine",
    f"""WITH {SQL_FEATURES}, g AS (SELECT vec_id, {_GUIDED_SQL} AS g FROM features)
        SELECT vec_id, unnest(range(32))::INTEGER AS pos, unnest(g) AS logit FROM g""",
)
def guided(spark, sf_dir):
    logits = guided_combine(*halves())
    return vectors(spark, sf_dir).select("vec_id", F.posexplode(logits).alias("pos", "logit"))


@query(
    "weighted_draw",
    f"""WITH {SQL_FEATURES},
        g AS (SELECT vec_id, {_GUIDED_SQL} AS g,
                     ('0x' || substr(md5(vec_id || ':draw'), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
              FROM features),
        e AS (SELECT vec_id, u, unnest(range(32)) AS pos,
                     exp(unnest(g) - list_max(g)) AS e FROM g),
        c AS (SELECT vec_id, u, sum(e) OVER (PARTITION BY vec_id ORDER BY pos) AS cdf,
                     sum(e) OVER (PARTITION BY vec_id) AS total FROM e)
        SELECT vec_id, least(count(*) FILTER (WHERE cdf <= u * total), 31)::INTEGER AS token
        FROM c GROUP BY vec_id""",
)
def draw(spark, sf_dir):
    token = weighted_draw_batch()(guided_combine(*halves()), key_uniform(F.col("vec_id"), F.lit("draw")))
    return vectors(spark, sf_dir).select("vec_id", token.alias("token"))


_LEVELS_SQL = (
    "list_transform(f, lambda x: floor(least(greatest((x + 1) / 2 * 255, 0), 255))::INTEGER)"
)


@query(
    "mask_pair",
    f"""WITH {SQL_FEATURES}, t AS (SELECT vec_id, {_LEVELS_SQL} AS t FROM features)
        SELECT vec_id, 'full' AS kind, array_to_string(t, ',') AS tokens FROM t
        UNION ALL
        SELECT vec_id, 'masked', array_to_string(list_transform(range(1, len(t) + 1),
                 lambda i: CASE WHEN i = 1 OR i = len(t) THEN t[i] ELSE -1 END), ',') FROM t""",
)
def masked(spark, sf_dir):
    rows = vectors(spark, sf_dir).select(
        "vec_id", F.inline(mask_pair(dequantize(F.col("features")), pad=-1))
    )
    return rows.withColumn("tokens", F.array_join("tokens", ","))


@query(
    "dequantize",
    f"""WITH {SQL_FEATURES} SELECT vec_id, array_to_string({_LEVELS_SQL}, ',') AS levels
        FROM features""",
)
def levels(spark, sf_dir):
    return vectors(spark, sf_dir).select(
        "vec_id", F.array_join(dequantize(F.col("features")), ",").alias("levels")
    )


@query(
    "axis_permute_grid",
    f"""WITH {SQL_FEATURES},
        flat AS (SELECT vec_id, unnest(range(64)) AS p, f FROM features)
        SELECT vec_id, (p // 8)::INTEGER AS "row", (p % 8)::INTEGER AS col,
               f[(p % 2) * 32 + p // 2 + 1] AS value FROM flat""",
)
def permuted(spark, sf_dir):
    # 2 channels of 4 x 8, laid out again as an 8 x 8 grid
    moved = channels_last(F.col("features"), channels=2, height=4, width=8)
    return vectors(spark, sf_dir).select("vec_id", F.inline(grid_cells(moved, width=8)))


@query(
    "head_cross_join",
    f"""WITH {SQL_HEADS} SELECT vec_id, head, b, scale, len(w)::INTEGER AS n_weights,
               list_aggregate(list_transform(w, lambda x: round(x * 100)::INTEGER), 'string_agg', ',')
                 AS weights_in_hundredths
        FROM embeddings CROSS JOIN heads""",
)
def crossed(spark, sf_dir):
    w = F.col("w")
    return head_rows(vectors(spark, sf_dir), HEADS).select(
        "vec_id",
        "head",
        "b",
        "scale",
        F.size(w).alias("n_weights"),
        F.array_join(F.transform(w, lambda x: F.round(x * 100).cast("int").cast("string")), ",").alias(
            "weights_in_hundredths"
        ),
    )


@query(
    "linear_head_score",
    f"""WITH {SQL_HEADS}, {SQL_FEATURES}
        SELECT vec_id, head, round((list_dot_product(f, w) + b) * scale, 6) AS score
        FROM features CROSS JOIN heads""",
)
def linear(spark, sf_dir):
    return score_long(image_features(spark, sf_dir), HEADS).withColumn("score", F.round("score", 6))


@query(
    "conditional_rescale",
    f"""WITH {SQL_HEADS}, {SQL_FEATURES},
        raw AS (SELECT vec_id, head, list_dot_product(f, w) + b AS s FROM features CROSS JOIN heads)
        SELECT vec_id, head,
               round(CASE WHEN head = 'Total aesthetic score' THEN s * 10 ELSE s END, 6) AS score
        FROM raw""",
)
def rescaled(spark, sf_dir):
    raw = score_long(image_features(spark, sf_dir), [replace(h, scale=1.0) for h in HEADS])
    score = conditional_rescale(F.col("score"), F.col("head"))
    return raw.withColumn("score", F.round(score, 6))


@query(
    "scores_to_wide",
    f"""WITH {SQL_HEADS}, {SQL_FEATURES},
        s AS (SELECT vec_id, h, round((list_dot_product(f, w) + b) * scale, 6) AS score
              FROM features CROSS JOIN heads)
        SELECT vec_id, {sql_wide_scores('score')} FROM s GROUP BY vec_id""",
)
def pivoted(spark, sf_dir):
    long = score_long(image_features(spark, sf_dir), HEADS).withColumn("score", F.round("score", 6))
    return scores_to_wide(long, ["vec_id"])


@query(
    "head_lookup_default",
    f"""WITH {SQL_HEADS}, {SQL_FEATURES},
        s AS (SELECT vec_id, h, round((list_dot_product(f, w) + b) * scale, 6) AS score
              FROM features CROSS JOIN heads)
        SELECT vec_id, {sql_wide_scores('score', (10,))} FROM s GROUP BY vec_id""",
)
def looked_up(spark, sf_dir):
    # the registry lacks the last head altogether
    found = head_lookup_default(scores_map(image_features(spark, sf_dir), HEADS[:-1]))
    return found.select("vec_id", *[F.round(c, 6).alias(c) for c in SCORE_FIELDS])


@query(
    "soft_fail_scoring",
    f"""WITH {SQL_HEADS}, {SQL_FEATURES}
        SELECT doc_id AS row_idx, head,
               CASE WHEN h <> {UNLOADED} THEN round((list_dot_product(f, w) + b) * scale, 6) END AS score
        FROM (documents LEFT JOIN features ON vec_id = doc_id) CROSS JOIN heads""",
)
def soft_fail(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_idx"))
    known = image_features(spark, sf_dir).withColumnRenamed("vec_id", "row_idx")
    rows = docs.join(known, "row_idx", "left")
    return score_long(rows, HEADS_ONE_MISSING).select(
        "row_idx", "head", F.round("score", 6).alias("score")
    )
