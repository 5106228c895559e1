"""Connected components by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.llm.common import materialize


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is joined to the node's smallest neighbour (or the node itself): a row per edge."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("__m"))
    return both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.least("u", "__m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours are joined to the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("__m"))
    moved = edges.join(least, "u").where("v <> __m").select(F.col("v").alias("u"), F.col("__m").alias("v"))
    return moved.union(least.select("u", F.col("__m").alias("v"))).distinct()


def _are_stars(edges: DataFrame) -> bool:
    """Whether every node has one larger end at most and none that is a smaller end as well."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("up")), F.struct(F.col("v").alias("node"), F.lit(0).alias("up")))).alias("e"))
    seen = ends.groupBy("e.node").agg(F.sum("e.up").alias("ups"), F.min("e.up").alias("least"))
    return seen.where("ups > 1 OR ups = 1 AND least = 0").isEmpty()


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge.

    ``edges``: two columns of integer node ids; direction, loops and repeats do not matter. Returns ``node``,
    ``component``. Only minima are taken per node and rows are joined back, so a node with very many neighbours is
    neither collected nor windowed. Each round is written to the shared folder; an empty input gives an empty result.
    Components found before may stand for the edges they come from. ``edges`` is read several times by the first round.
    """
    a, b = edges.columns
    kept = edges.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    while True:
        kept = materialize(_small_star(_large_star(kept)), "edges")
        if _are_stars(kept):  # another round would change nothing
            break
    roots = kept.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return kept.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
