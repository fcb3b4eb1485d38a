"""Vector operators on array columns.

The functions ending in ``_batch`` are Arrow UDFs for wide vectors: Spark
partitions the rows, numpy works on one record batch at a time.  The others are
built-in expressions.  Inside a lambda an outer expression is evaluated for each
element, so shared values are bound once with :func:`bind`.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
GUIDANCE_WEIGHT = 5.0
TEMPERATURE = 1.0
TOKEN_GRID_WIDTH = 24  # 384 pixels in patches of 16
# --- end of fixed values ----------------------------------------------------


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def doubles(vector: Column) -> Column:
    return vector.cast("array<double>")


def guided_combine(cond: Column, uncond: Column, weight: float = GUIDANCE_WEIGHT) -> Column:
    """Move from the unconditional towards and past the conditional vector."""
    return F.zip_with(cond, uncond, lambda c, u: u + F.lit(float(weight)) * (c - u))


def softmax(logits: Column, temperature: float = TEMPERATURE) -> Column:
    """Probabilities of the logits, shifted by their maximum before ``exp``."""

    def normalised(weights: Column) -> Column:
        return bind(_total(weights), lambda t: F.transform(weights, lambda e: e / t))

    return bind(_exp_shifted(logits, temperature), normalised)


def weighted_draw(logits: Column, uniform: Column, temperature: float = TEMPERATURE) -> Column:
    """Position drawn from the softmax of the logits by inverse CDF.

    ``uniform`` comes from :func:`variantflow.functions.text.key_uniform`, which
    makes the draw repeatable.  NULL for a NULL or empty vector.
    """

    def draw(weights: Column) -> Column:
        def position(target: Column) -> Column:
            start = F.struct(F.lit(0.0).alias("acc"), F.lit(0).alias("n"))

            def step(s: Column, e: Column) -> Column:
                acc = s["acc"] + e
                n = s["n"] + F.when(acc <= target, 1).otherwise(0)
                return F.struct(acc.alias("acc"), n.alias("n"))

            return F.aggregate(
                weights, start, step, lambda s: F.least(s["n"], F.size(weights) - 1)
            )

        return bind(uniform * _total(weights), position)

    return F.when(F.size(logits) > 0, bind(_exp_shifted(logits, temperature), draw))


def _exp_shifted(logits: Column, temperature: float) -> Column:
    return bind(
        F.array_max(logits),
        lambda top: F.transform(logits, lambda x: F.exp((x - top) / F.lit(float(temperature)))),
    )


def _total(weights: Column) -> Column:
    return F.aggregate(weights, F.lit(0.0), lambda s, e: s + e)


def mask_pair(tokens: Column, pad: int) -> Column:
    """The tokens and a copy whose inner tokens are padding, as two labelled rows."""

    def pair(t: Column) -> Column:
        masked = F.concat(
            F.slice(t, 1, 1),
            F.array_repeat(F.lit(pad), F.greatest(F.size(t) - 2, F.lit(0))),
            F.slice(t, F.greatest(F.size(t), F.lit(2)), F.lit(1)),
        )
        return F.array(
            F.struct(F.lit("full").alias("kind"), t.alias("tokens")),
            F.struct(F.lit("masked").alias("kind"), masked.alias("tokens")),
        )

    return bind(tokens, pair)


def dequantize(values: Column) -> Column:
    """Map [-1, 1] to whole numbers 0..255; NULL stays NULL and NaN becomes NULL."""

    def level(x: Column) -> Column:
        scaled = (x + F.lit(1)) / F.lit(2) * F.lit(255)
        clipped = F.least(F.greatest(scaled, F.lit(0.0)), F.lit(255.0))
        return F.when(~F.isnan(x) & x.isNotNull(), F.floor(clipped).cast("int"))

    return F.transform(values, level)


def channels_last(values: Column, channels: int, height: int, width: int) -> Column:
    """Reorder a flat (channel, row, column) array to (row, column, channel)."""
    area = height * width

    def reordered(v: Column) -> Column:
        def source(p: Column) -> Column:
            channel = p % F.lit(channels)
            pixel = F.floor(p / F.lit(channels)).cast("int")
            return F.get(v, channel * F.lit(area) + pixel)

        return F.transform(F.sequence(F.lit(0), F.lit(channels * area - 1)), source)

    return bind(values, reordered)


def grid_cells(values: Column, width: int = TOKEN_GRID_WIDTH) -> Column:
    """Array of (row, col, value) structs for a flat row-major array; explode it."""
    return F.transform(
        values,
        lambda x, i: F.struct(
            F.floor(i / F.lit(width)).cast("int").alias("row"),
            (i % F.lit(width)).cast("int").alias("col"),
            x.alias("value"),
        ),
    )


def widths_of(vectors: pa.Array) -> np.ndarray:
    """Length of each list, -1 for NULL."""
    return vectors.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)


def matrix_of(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``width`` numbers as a float64 matrix, and their row numbers.

    Rows of another length, NULL rows and rows that hold a NULL are left out.
    """
    lengths = widths_of(vectors)
    usable = lengths == width
    values = vectors.flatten()
    if values.null_count:
        owner = np.repeat(np.arange(len(vectors)), np.maximum(lengths, 0))
        usable[owner[values.is_null().to_numpy(zero_copy_only=False)]] = False
    rows = np.flatnonzero(usable)
    if rows.size < len(vectors):
        values = vectors.take(pa.array(rows)).flatten()
    flat = values.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(rows.size, width), rows


def weighted_draw_batch(temperature: float = TEMPERATURE) -> Callable[[Column, Column], Column]:
    """:func:`weighted_draw` for wide vectors as an Arrow UDF."""

    @F.arrow_udf("int")
    def draw(logits: pa.Array, uniform: pa.Array) -> pa.Array:
        out = np.zeros(len(logits), dtype=np.int32)
        missing = np.ones(len(logits), dtype=bool)
        chance = uniform.to_numpy(zero_copy_only=False)
        lengths = widths_of(logits)
        for width in np.unique(lengths[lengths > 0]):
            matrix, rows = matrix_of(logits, int(width))
            if rows.size == 0:
                continue
            weights = np.exp((matrix - matrix.max(axis=1, keepdims=True)) / temperature)
            cdf = np.cumsum(weights, axis=1)
            below = cdf <= (chance[rows] * cdf[:, -1])[:, None]
            out[rows] = np.minimum(below.sum(axis=1), width - 1)
            missing[rows] = False
        return pa.array(out, mask=missing)

    return draw
