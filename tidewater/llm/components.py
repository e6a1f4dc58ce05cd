"""Connected components of an edge table by alternating large-star and small-star."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import stored


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over (a, b) edges with a > b; gives such edges again.

    Large star: every larger neighbour of u moves to the smallest node around u.
    Small star: u and its smaller neighbours do. The smallest node comes from a
    pre-aggregated minimum and is joined back, so that the neighbours of a hub
    are never gathered in one row or task.
    """
    if large:
        around = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        around = edges
    least = around.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    least = least.select("u", F.least("u", "m").alias("m"))
    moved = around.join(least, F.col("a") == F.col("u"))
    if large:
        out = moved.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = (moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
                    .union(least.select(F.col("u").alias("a"), F.col("m").alias("b"))))
    return out.where(F.col("a") != F.col("b")).distinct()


def components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component) for every node of an edge, the component being its smallest node.

    Loops and repeated edges are harmless. Each round's edges are written to
    the shared folder; the rounds end when a round changes nothing, which is
    logarithmic in the longest path in practice. Only a count and a checksum
    of the edges come to the driver.
    """
    now = (edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                .where(F.col("a") > F.col("b")).distinct())
    now, last = stored(now, "edges"), None
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == last or not mark[0]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
                now.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
        last = mark
        now = stored(_star(_star(now, True), False), "edges")
