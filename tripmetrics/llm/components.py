"""Connected components of a graph that no machine holds whole."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmetrics.llm.common import kept


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def _large_star(edges: DataFrame) -> DataFrame:
    """Hang every larger neighbour of a node on the smallest of the node and its neighbours."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("least"))
    return (
        both.join(least, "u")
        .filter(F.col("v") > F.col("u"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    """Hang a node and its smaller neighbours on the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    moved = (
        edges.join(least, "u")
        .filter(F.col("v") != F.col("least"))
        .select(F.col("v").alias("u"), F.col("least").alias("v"))
    )
    return moved.union(least.select("u", F.col("least").alias("v"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, for each node that has a link.

    ``links`` has the columns a and b of one type. Loops, repeated links and links with a null end
    say nothing and are left out. Large-star and small-star steps alternate until nothing moves;
    each round is written to the shared folder, so lineage stays short and nothing is lost with an
    executor. Rounds grow with the logarithm of the longest chain.
    """
    edges = kept(
        links.filter(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    state = _state(edges)
    while state[0]:
        edges = kept(_small_star(_large_star(edges)), "edges")
        before, state = state, _state(edges)
        if state == before:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
        edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )
