"""Run counters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from variantflow.schemas import OUTCOMES


def run_counters(df: DataFrame, by: Sequence[str] = ("variant", "outcome")) -> DataFrame:
    """Rows for each variant and outcome."""
    return df.groupBy(*by).agg(F.count("*").alias("n_rows"))


def observed(df: DataFrame, name: str = "run") -> tuple[DataFrame, Observation]:
    """Count rows and outcomes while ``df`` is written; no pass of its own."""
    watch = Observation(name)
    totals = [F.count_if(F.col("outcome") == o).alias(o) for o in OUTCOMES]
    return df.observe(watch, F.count(F.lit(1)).alias("rows"), *totals), watch
