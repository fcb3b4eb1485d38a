"""Stage 3: scores of every artifact by every head."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.operators.manifest import manifest_join
from variantflow.operators.scoring import Head, score_wide
from variantflow.sources.artifacts import probe_artifacts


def score(
    rows: DataFrame,
    features: DataFrame,
    heads: Sequence[Head],
    *,
    key: Sequence[str] = ("row_idx", "variant"),
    feature_key: Sequence[str] = ("row_idx", "variant"),
    manifest: DataFrame | None = None,
    path: str = "generated_filename",
    listing: bool = False,
) -> DataFrame:
    """Every row, with all its columns and one score column for each head.

    ``features`` has the ``feature_key`` columns, unique, and ``features``.
    Existence comes from a manifest table or, without one, from a test of each
    path inside the tasks.  A manifest may repeat paths unless it is a
    ``listing``, and may say in ``readable`` whether a file could be read.  Rows
    without a readable artifact or without features keep NULL scores; so do rows
    with a NULL key.  Rows that share key and path are scored once and all kept.

    Keys, paths and features are joined and scored first.  The texts of the
    rows take part in the last join only, so they are shuffled once.
    """
    narrow = rows.select(*key, path).distinct()
    if manifest is None:
        checked = probe_artifacts(narrow, path)
    else:
        carry = ["readable"] if "readable" in manifest.columns else []
        checked = manifest_join(narrow, manifest, path, salt=key, carry=carry, distinct=listing)
        if carry:
            fine = F.col("present") & F.coalesce("readable", F.lit(False))
            checked = checked.withColumn("present", fine).drop("readable")
    # rows with a NULL key have no features: they need not meet in one task
    keyed = reduce(and_, [F.col(c).isNotNull() for c in feature_key])
    vectors = features.select(*feature_key, "features")
    known = checked.filter(keyed).join(vectors, list(feature_key), "left")
    scored = score_wide(known, heads, present="present").drop("features", "present")
    names = [c for c in scored.columns if c not in (*key, path)]
    right = scored.select(*[F.col(c).alias(f"_right_{c}") for c in (*key, path)], *names)
    same = [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in (*key, path)]
    return rows.join(right, reduce(and_, same), "left").select(*[rows[c] for c in rows.columns], *names)
