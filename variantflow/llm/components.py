"""Connected components of an edge table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from variantflow.sources.scratch import written


def _stars(edges: DataFrame, large: bool) -> DataFrame:
    """Hang the neighbours of each node on its smallest neighbour (a > b in every edge)."""
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = edges
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    hung = both.join(least, "a")
    if large:
        out = hung.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = hung.select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of ``edges`` (a long, b long).

    ``component`` is the smallest node of the component.  Direction, repeated
    edges and loops do not matter; edges with a NULL end are ignored.  Every
    round is written, so it is not computed twice, also when executors are
    lost.  The number of rounds grows with the logarithm of the longest path.
    """
    edges = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    edges = written(edges.distinct(), "components")
    before = None
    while True:
        state = edges.agg(
            F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
        ).first()
        if state.n == 0 or (before is not None and tuple(state) == before):
            break
        before = tuple(state)
        edges = written(_stars(_stars(edges, True), False), "components")
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots)
