"""Connected components of a link table, as a loop of joins over written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vendaval.llm.shared import keep


def connected_components(links: DataFrame, limit: int = 100) -> DataFrame:
    """(node, component): the smallest node reachable from each node that has a link.

    ``links`` has (a, b), both non-null and of one type. Alternates two steps (large star,
    small star) that hang every node on the smallest one it knows, until nothing changes;
    each step is a minimum per node, computed with partial aggregates and written, and a join
    with it, so that both sides of the join come straight from a shuffle and adaptive execution
    can split a node with very many links. The number of rounds grows with the logarithm of the
    longest chain.
    """
    edges = _canonical(links.select("a", "b"))
    edges = keep(edges, "links")
    seen = None
    for _ in range(limit):
        edges = keep(_small_star(_large_star(edges)), "links")
        mark = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError("links did not settle")
    leaves = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return leaves.unionByName(roots)


def _canonical(edges: DataFrame) -> DataFrame:
    """Each link once, from the larger node to the smaller."""
    ordered = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    return ordered.distinct()


def _large_star(edges: DataFrame) -> DataFrame:
    """Links the larger neighbours of each node to the smallest of node and neighbours."""
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    least = keep(least, "least")
    return _canonical(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))


def _small_star(edges: DataFrame) -> DataFrame:
    """Links each node and its smaller neighbours to the smallest of them."""
    least = keep(edges.groupBy("a").agg(F.min("b").alias("m")), "least")
    moved = edges.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return _canonical(moved.unionByName(least.select("a", F.col("m").alias("b"))))
