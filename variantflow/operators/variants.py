"""The variant dimension: long and wide forms, unions and routing."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from variantflow.schemas import VARIANTS, slug_of


def fan_out(df: DataFrame, variants: Sequence[str] = VARIANTS) -> DataFrame:
    """Each row once for each variant, with ``variant`` and ``slug`` columns.

    A generator over a literal array: no shuffle and no join.  Filters on the
    source columns still reach the scan.
    """
    pairs = F.array(
        *[F.struct(F.lit(v).alias("variant"), F.lit(slug_of(v)).alias("slug")) for v in variants]
    )
    return df.select("*", F.inline(pairs))


def union_variants(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One long table from one table for each variant; columns may differ."""
    tagged = [
        t.withColumns({"variant": F.lit(v), "slug": F.lit(slug_of(v))}) for v, t in tables.items()
    ]
    union = tagged[0]
    for table in tagged[1:]:
        union = union.unionByName(table, allowMissingColumns=True)
    return union


def assemble_wide(
    long: DataFrame,
    key: str | Sequence[str] = "row_idx",
    value: str = "reply",
    *,
    order: str | None = None,
    variants: Sequence[str] = VARIANTS,
    prefix: str = "description_",
) -> DataFrame:
    """One row for each key with a column for each variant.

    One aggregation on the key with a partial step before the shuffle; the long
    texts move once.  With ``order`` the row with the largest value wins, so an
    upsert and the pivot share a shuffle.
    """
    rank = F.col(order) if order else F.lit(0)

    def cell(variant: str) -> Column:
        mine = F.when(F.col("variant") == variant, F.struct(rank.alias("o"), F.col(value).alias("v")))
        return F.max(mine)["v"].alias(prefix + slug_of(variant))

    keys = [key] if isinstance(key, str) else list(key)
    return long.groupBy(*keys).agg(*[cell(v) for v in variants])


def split_wide(
    wide: DataFrame,
    keep: Sequence[str] = ("row_idx",),
    value: str = "reply",
    *,
    variants: Sequence[str] = VARIANTS,
    prefix: str = "description_",
) -> DataFrame:
    """Long form of :func:`assemble_wide`; NULL cells stay as rows."""
    cells = F.array(
        *[
            F.struct(
                F.lit(v).alias("variant"),
                F.lit(slug_of(v)).alias("slug"),
                F.col(prefix + slug_of(v)).alias(value),
            )
            for v in variants
        ]
    )
    return wide.select(*keep, F.inline(cells))


def dispatch_by_variant(
    df: DataFrame, prefix: str = "dataset_", variants: Sequence[str] = VARIANTS
) -> DataFrame:
    """Name the target table of each row; rows of unknown variants are left out."""
    known = df.filter(F.col("variant").isin(*variants))
    return known.withColumn("target", F.concat(F.lit(prefix), F.replace("variant", F.lit(" "), F.lit("_"))))


def variant_tables(df: DataFrame, variants: Sequence[str] = VARIANTS) -> dict[str, DataFrame]:
    """The rows of each variant as a table of its own, lazily."""
    return {v: df.filter(F.col("variant") == v) for v in variants}
