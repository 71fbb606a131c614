"""Connected components of a graph of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartstream.llm.tables import written


def _state(edges: DataFrame) -> tuple[int, int]:
    mark = F.sum(F.xxhash64("a", "b").bitwiseAND(F.lit((1 << 40) - 1))).alias("mark")
    row = edges.agg(F.count("*").alias("n"), mark).first()
    return row["n"], row["mark"] or 0


def components(links: DataFrame) -> DataFrame:
    """(node, component) for links (a, b) between long ids: each node with the
    smallest id that can be reached. Nodes without links are not in it.

    Large-star and small-star steps in turn: each node points its larger
    neighbours, then its smaller ones, to its smallest neighbour. Edges become
    stars around the smallest ids in few rounds, chains included, and no step
    gathers a node's neighbours: they are only reduced to their minimum.
    """
    edges = links.where("a != b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    ).distinct()
    edges = written(edges, "links", slim=True)
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min(F.least("a", "b")).alias("m"))
        edges = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = written(edges.distinct(), "large-star", slim=True)
        low = edges.groupBy("a").agg(F.min("b").alias("m"))
        moved = edges.join(low, "a").where("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = moved.union(low.select("a", F.col("m").alias("b"))).distinct()
        edges = written(edges, "small-star", slim=True)
        before, state = state, _state(edges)
        if state == before:
            break
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)
