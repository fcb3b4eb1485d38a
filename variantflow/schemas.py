"""Names, fixed values and table schemas shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
# The four tones each description is rewritten in.
VARIANTS = ("positive", "very positive", "negative", "very negative")

# The eleven scores of an image, in export order.
SCORE_COLUMNS = (
    "Total aesthetic score",
    "Theme and logic",
    "Creativity",
    "Layout and composition",
    "Space and perspective",
    "The sense of order",
    "Light and shadow",
    "Color",
    "Details and texture",
    "The overall",
    "Mood",
)

# The only score whose model output is multiplied, and its factor.
RESCALED_SCORE = "Total aesthetic score"
RESCALE_FACTOR = 10.0

# Markers that a CSV reader for data frames takes as a missing value.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)
# --- end of fixed values ----------------------------------------------------

OUTCOMES = ("ok", "empty", "failed", "null_input")


def slug_of(variant: str) -> str:
    """Form of a variant used in column names and paths."""
    return variant.replace(" ", "_")


SLUGS = tuple(slug_of(v) for v in VARIANTS)


def snake_case(score: str) -> str:
    """Internal column name of a score."""
    return score.lower().replace(" ", "_")


SCORE_FIELDS = tuple(snake_case(s) for s in SCORE_COLUMNS)

INFERENCE_FIELDS = (
    T.StructField("pass", T.IntegerType(), False),
    T.StructField("reply", T.StringType()),
    T.StructField("attempts", T.IntegerType(), False),
    T.StructField("total_delay_s", T.DoubleType(), False),
    T.StructField("outcome", T.StringType(), False),
)

# One row for each finished call.  ``logged_at`` (milliseconds) tells runs apart.
LOG_SCHEMA = T.StructType(
    [
        T.StructField("row_idx", T.LongType()),
        T.StructField("variant", T.StringType()),
        T.StructField("original_text", T.StringType()),
        *[T.StructField(f.name, f.dataType) for f in INFERENCE_FIELDS],
        T.StructField("logged_at", T.LongType()),
    ]
)

# As stored: with the name of the text, which tells apart rows that share a key.
STORED_LOG_SCHEMA = T.StructType([*LOG_SCHEMA.fields, T.StructField("text_id", T.StringType())])

STATE_SCHEMA = T.StructType(
    [
        T.StructField("row_idx", T.LongType()),
        T.StructField("variant", T.StringType()),
        T.StructField("original_text", T.StringType()),
        T.StructField("reply", T.StringType()),
        T.StructField("pass", T.IntegerType()),
    ]
)

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("row_idx", T.LongType()),
        T.StructField("variant", T.StringType()),
        T.StructField("original_text", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
    ]
)


def variant_state_schema(variant: str) -> T.StructType:
    """Two-column state table of one variant."""
    return T.StructType(
        [
            T.StructField("description_original", T.StringType()),
            T.StructField(f"description_{slug_of(variant)}", T.StringType()),
        ]
    )
