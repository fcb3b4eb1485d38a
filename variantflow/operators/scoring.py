"""Many regression heads on one feature vector."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantflow.functions.arrays import doubles, matrix_of
from variantflow.schemas import RESCALE_FACTOR, RESCALED_SCORE, SCORE_COLUMNS, snake_case


@dataclass(frozen=True)
class Head:
    """A linear regressor.  ``w`` is None where its model could not be loaded."""

    name: str
    w: tuple[float, ...] | None
    b: float = 0.0
    scale: float = 1.0

    @property
    def field(self) -> str:
        return snake_case(self.name)


def heads_from_weights(weights: dict[str, tuple[Sequence[float], float] | None]) -> list[Head]:
    """The registry: one head for each score column, known or not."""
    heads = []
    for name in SCORE_COLUMNS:
        found = weights.get(name)
        scale = RESCALE_FACTOR if name == RESCALED_SCORE else 1.0
        w, b = found if found else (None, 0.0)
        heads.append(Head(name, tuple(map(float, w)) if w is not None else None, float(b), scale))
    return heads


def vector_literal(values: Sequence[float] | None) -> Column:
    """Constant vector from one string, folded by the optimizer.

    ``F.lit`` of a list builds a JVM object for each number, which takes seconds
    for a few thousand weights.
    """
    text = F.lit(None) if values is None else F.lit(",".join(map(repr, values)))
    return F.split(text.cast("string"), ",").cast("array<double>")


def head_rows(df: DataFrame, heads: Sequence[Head]) -> DataFrame:
    """Each row once for each head, with columns ``head, w, b, scale``.

    The registry is a handful of models, so it is a literal array: no join.
    """

    def literal(h: Head) -> Column:
        return F.struct(
            F.lit(h.name).alias("head"),
            vector_literal(h.w).alias("w"),
            F.lit(float(h.b)).alias("b"),
            F.lit(float(h.scale)).alias("scale"),
        )

    return df.select("*", F.inline(F.array(*[literal(h) for h in heads])))


def linear_score(features: Column, w: Column, b: Column) -> Column:
    """``b + features . w``; NULL where either vector is NULL or lengths differ."""
    products = F.zip_with(doubles(features), w, lambda f, v: f * v)
    return F.aggregate(products, b.cast("double"), lambda total, p: total + p)


def conditional_rescale(score: Column, head: Column, factor: float = RESCALE_FACTOR) -> Column:
    """The one score that is reported on a larger scale, others unchanged."""
    return F.when(head == RESCALED_SCORE, score * F.lit(float(factor))).otherwise(score)


def number_or_null(score: Column) -> Column:
    return F.when(~F.isnan(score), score)


def score_long(df: DataFrame, heads: Sequence[Head], features: str = "features") -> DataFrame:
    """The other columns with (head, score) rows; failures are NULL scores."""
    rest = [c for c in df.columns if c != features]
    names = F.lit([h.name for h in heads])
    pairs = F.arrays_zip(names.alias("head"), F.col("_scores").alias("score"))
    scored = df.select(*rest, score_vector(heads)(F.col(features)).alias("_scores"))
    return scored.select(*rest, F.inline(pairs).alias("head", "score"))


def score_long_builtin(
    df: DataFrame, heads: Sequence[Head], features: str = "features"
) -> DataFrame:
    """:func:`score_long` from built-in expressions alone.

    Measured several times slower than the matrix product at 64 numbers and 11
    heads; for sessions without Python workers.
    """
    rows = head_rows(df, heads)
    score = linear_score(F.col(features), F.col("w"), F.col("b")) * F.col("scale")
    return rows.withColumn("score", number_or_null(score)).drop(features, "w", "b", "scale")


def score_vector(heads: Sequence[Head]):
    """Arrow UDF: features -> array with the scaled score of each head.

    One matrix product for each record batch and vector width.  A head without
    weights, of another width or with a NaN result gives NULL for that head
    only; NULL features give NULL for all.
    """
    groups: dict[int, list[int]] = {}
    for i, h in enumerate(heads):
        if h.w is not None:
            groups.setdefault(len(h.w), []).append(i)
    blocks = [
        (
            width,
            members,
            np.array([heads[i].w for i in members], dtype=np.float64).T,
            np.array([heads[i].b for i in members]),
            np.array([heads[i].scale for i in members]),
        )
        for width, members in groups.items()
    ]
    n_heads = len(heads)

    @F.arrow_udf("array<double>")
    def score(features: pa.Array) -> pa.Array:
        out = np.full((len(features), n_heads), np.nan)
        for width, members, w, b, scale in blocks:
            matrix, rows = matrix_of(features, width)
            with np.errstate(all="ignore"):
                out[np.ix_(rows, members)] = (matrix @ w + b) * scale
        flat = out.reshape(-1)
        values = pa.array(flat, mask=np.isnan(flat))
        offsets = np.arange(len(features) + 1, dtype=np.int32) * n_heads
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    return score


def score_wide(
    df: DataFrame,
    heads: Sequence[Head],
    features: str = "features",
    present: str | None = None,
) -> DataFrame:
    """One column for each head, without a shuffle or a pivot.

    With ``present`` the scores of rows whose artifact is missing are NULL.
    """
    vector = F.col(features)
    if present:
        vector = F.when(F.col(present), vector)
    scored = df.withColumn("_scores", score_vector(heads)(vector))
    cells = {h.field: F.get("_scores", F.lit(i)) for i, h in enumerate(heads)}
    return scored.withColumns(cells).drop("_scores")


def scores_to_wide(
    long: DataFrame, key: Sequence[str], heads: Sequence[str] = SCORE_COLUMNS
) -> DataFrame:
    """Pivot (key, head, score) rows to one column for each head.

    Conditional aggregates need one shuffle; the partial step folds the heads
    of a key before it.
    """
    cells = [F.max(F.when(F.col("head") == h, F.col("score"))).alias(snake_case(h)) for h in heads]
    return long.groupBy(*key).agg(*cells)


def head_lookup_default(
    df: DataFrame, scores: str = "scores", heads: Sequence[str] = SCORE_COLUMNS
) -> DataFrame:
    """A column for each required head from a map of scores; absent means NULL."""
    cells = {snake_case(h): F.try_element_at(scores, F.lit(h)) for h in heads}
    return df.withColumns(cells)


def scores_map(df: DataFrame, heads: Sequence[Head], features: str = "features") -> DataFrame:
    """Scores of a row as a map from head to number."""
    names = F.lit([h.name for h in heads])
    return df.withColumn("scores", F.map_from_arrays(names, score_vector(heads)(F.col(features))))


def export_names(df: DataFrame) -> DataFrame:
    """Score columns under their published names."""
    renamed = {snake_case(s): s for s in SCORE_COLUMNS}
    return df.select(*[F.col(c).alias(renamed.get(c, c)) for c in df.columns])
