"""Connected components of a link table by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step on edges ``(u, v)``: neighbours of ``u`` are tied to the least of them."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else edges
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    # The join is by a node with one row on the right; a node with very many links is
    # split by Spark's skew join.
    tied = both.join(least, "u")
    if large:
        out = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = tied.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.where(F.col("u") != F.col("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x")).first()
    return r.n, r.x


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """``node, root`` of every node that has a link; ``root`` is the least node of its component.

    Each round is written to the shared folder, so the plan stays short and a lost
    executor costs one round at most.
    """
    edges = written(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
                    .where(F.col("u") != F.col("v")).distinct(), "cc")
    state = _state(edges)
    while state[0]:
        edges = written(_star(_star(edges, True).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")),
                              False), "cc")
        new = _state(edges)
        if new == state:
            break
        state = new
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
