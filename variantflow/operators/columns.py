"""Column selection that copes with absent columns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def project_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Only the required columns, renamed: ``{new name: source name}``."""
    return df.select(*[F.col(source).alias(name) for name, source in columns.items()])


def optional_column(df: DataFrame, name: str, dtype: str = "string") -> Column:
    """The column, or NULL of the given type where the table lacks it."""
    present = {c.lower() for c in df.columns}
    column = F.col(f"`{name}`") if name.lower() in present else F.lit(None).cast(dtype)
    return column.alias(name)


def add_or_replace_columns(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Set several columns in one projection; all others pass through."""
    return df.withColumns(dict(columns))
