"""Stage 2: prompts and artifact paths for every variant."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.functions.text import (
    PLAIN_DIALECT,
    ChatDialect,
    artifact_path,
    chat_prompt,
)
from variantflow.operators.variants import fan_out
from variantflow.schemas import VARIANTS


def generation_requests(
    long: DataFrame,
    directory: str,
    start_tag: str,
    *,
    text: str = "reply",
    dialect: ChatDialect = PLAIN_DIALECT,
) -> DataFrame:
    """Add ``prompt`` and ``generated_filename`` to a long table.  Narrow."""
    return long.withColumns(
        {
            "prompt": chat_prompt(F.col(text), start_tag, dialect),
            "generated_filename": artifact_path(directory, F.col("slug"), F.col("row_idx")),
        }
    )


def variant_manifest(
    wide: DataFrame, directory: str, variants: Sequence[str] = VARIANTS
) -> DataFrame:
    """A wide table once for each variant, with the path of its artifact.

    All source columns pass through; write it routed by ``slug`` to get one
    table for each variant.
    """
    rows = fan_out(wide, variants)
    path = artifact_path(directory, F.col("slug"), F.col("row_idx"))
    return rows.withColumn("generated_filename", path)


