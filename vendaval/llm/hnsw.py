"""Operator 5, approximate nearest neighbours: one small-world graph per shard, results merged.

Vectors are dealt to shards of bounded size by a hash. Each shard gets a hierarchical
navigable small-world graph, stored as one row of flat neighbour arrays. Blocks of queries
meet every shard, and the best of all shards are kept per query. Rows with equal vectors
share a node, so a vector that a third of all rows hold is one node of one graph.
"""

from __future__ import annotations

from dataclasses import dataclass
from heapq import heappop, heappush, heapreplace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vendaval.llm.shared import keep


@dataclass(frozen=True)
class Search:
    """Sizes of graphs and searches."""

    neighbours: int = 5  # wanted per query
    shard: int = 4096  # different vectors in a shard, on average
    block: int = 2048  # queries that meet a shard at once
    links: int = 16  # per node and upper layer; twice as many in the lowest
    build: int = 96  # candidates looked at when a node is linked
    breadth: int = 96  # candidates looked at by a query
    seed: int = 11


class Graph:
    """A graph over unit vectors; ``links[layer]`` holds each node's neighbours, -1 for none."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], entry: int):
        self.vectors, self.links, self.entry = vectors, links, entry

    @classmethod
    def build(cls, vectors: np.ndarray, search: Search) -> Graph:
        n, m = len(vectors), search.links
        draws = np.random.default_rng(search.seed).random(n)
        top = np.minimum((-np.log(1.0 - draws) / np.log(m)).astype(int), 8)
        links = [np.full((n, 2 * m if layer == 0 else m), -1, dtype=np.int32) for layer in range(int(top.max()) + 1)]
        graph = cls(vectors, links, 0)
        for node in range(1, n):
            graph._insert(node, int(top[node]), int(top[graph.entry]), search)
            if top[node] > top[graph.entry]:
                graph.entry = node
        return graph

    def _insert(self, node: int, top: int, highest: int, search: Search) -> None:
        query = self.vectors[node]
        found = [(float(self.vectors[self.entry] @ query), self.entry)]
        for layer in range(highest, -1, -1):
            if layer > top:
                found = self.nearest(query, found, 1, layer)
                continue
            found = self.nearest(query, found, search.build, layer)
            chosen = self._spread([v for _, v in found], node, search.links)
            row = self.links[layer]
            row[node, : len(chosen)] = chosen
            for v in chosen:
                own = row[v]
                free = np.flatnonzero(own < 0)
                if len(free):
                    own[free[0]] = node
                else:
                    kept = self._spread([*own.tolist(), node], v, len(own))
                    own[:] = -1
                    own[: len(kept)] = kept

    def _spread(self, candidates: list[int], node: int, most: int) -> list[int]:
        """Near neighbours in different directions: none nearer to a chosen one than to the node.

        Places left over go to the nearest of those passed by.
        """
        points = self.vectors[candidates]
        own = points @ self.vectors[node]
        between = points @ points.T
        chosen, passed = [], []
        reach = np.full(len(candidates), -np.inf, dtype=points.dtype)
        for i in np.argsort(-own, kind="stable").tolist():
            if len(chosen) == most:
                break
            if own[i] > reach[i]:
                chosen.append(i)
                np.maximum(reach, between[i], out=reach)
            else:
                passed.append(i)
        chosen += passed[: most - len(chosen)]
        return [candidates[i] for i in chosen]

    def nearest(self, query: np.ndarray, starts: list[tuple[float, int]], width: int, layer: int) -> list[tuple[float, int]]:
        """The best ``width`` nodes met when walking a layer from ``starts``, best first."""
        vectors, row = self.vectors, self.links[layer]
        seen = bytearray(len(vectors))
        best: list[tuple[float, int]] = []
        open_: list[tuple[float, int]] = []
        for score, node in starts:
            seen[node] = 1
            heappush(open_, (-score, node))
            heappush(best, (score, node))
        while len(best) > width:
            heappop(best)
        while open_:
            score, node = heappop(open_)
            if len(best) >= width and -score < best[0][0]:
                break
            fresh = [v for v in row[node].tolist() if v >= 0 and not seen[v]]
            if not fresh:
                continue
            for v, s in zip(fresh, (vectors[fresh] @ query).tolist()):
                seen[v] = 1
                if len(best) < width:
                    heappush(best, (s, v))
                elif s > best[0][0]:
                    heapreplace(best, (s, v))
                else:
                    continue
                heappush(open_, (-s, v))
        return sorted(best, reverse=True)

    def search(self, query: np.ndarray, breadth: int) -> list[int]:
        found = [(float(self.vectors[self.entry] @ query), self.entry)]
        for layer in range(len(self.links) - 1, -1, -1):
            found = self.nearest(query, found, breadth if layer == 0 else 1, layer)
        return [v for _, v in found]


def usable(vectors: DataFrame) -> DataFrame:
    """(vec_id, vector) of rows with an id and a vector of finite components, not all zero."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull())
    # Floats are exact as doubles.
    kept = rows.where(finite & some)
    return kept.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))


def _unit(vectors: np.ndarray) -> np.ndarray:
    # The largest component first, so that squares neither overflow nor vanish.
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return (scaled / np.linalg.norm(scaled, axis=1, keepdims=True)).astype(np.float32)


def _tasks(rows: DataFrame) -> int:
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def build_index(vectors: DataFrame, search: Search = Search()) -> DataFrame:
    """One row per shard: its vectors, their ids and the graph, as flat arrays.

    Of equal vectors the ``neighbours + 1`` smallest ids are kept, which is all that a search
    can return; repeated rows count once. Vectors of different length live in different shards.
    """
    points = usable(vectors).distinct()
    place = Window.partitionBy("vector").orderBy("vec_id")
    few = points.withColumn("nth", F.row_number().over(place)).where(F.col("nth") <= search.neighbours + 1)
    nodes = few.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = keep(nodes.withColumn("dim", F.size("vector")), "vectors")
    sizes = nodes.groupBy("dim").agg(F.ceil(F.count("*") / search.shard).alias("shards"))
    dealt = nodes.join(sizes, "dim").withColumn("shard", F.pmod(F.xxhash64("vector"), F.col("shards")))
    # By number: a shard is few bytes and much work, so shards must not be gathered by size.
    dealt = dealt.repartition(_tasks(vectors), "dim", "shard")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        # Sorted, so that a repeated task builds the same graph.
        rows = rows.iloc[np.argsort([i[0] for i in rows["ids"]], kind="stable")]
        points = np.stack(rows["vector"].to_list())
        graph = Graph.build(_unit(points), search)
        return pd.DataFrame(
            {
                "dim": [rows["dim"].iloc[0]],
                "shard": [rows["shard"].iloc[0]],
                "shards": [rows["shards"].iloc[0]],
                "vectors": [points.tobytes()],
                "ids": [np.concatenate([np.asarray(i) for i in rows["ids"]])],
                "id_counts": [np.array([len(i) for i in rows["ids"]])],
                "links": [[layer.tobytes() for layer in graph.links]],
                "entry": [graph.entry],
            }
        )

    kind = (
        "dim int, shard long, shards long, vectors binary, ids array<long>, id_counts array<int>,"
        " links array<binary>, entry int"
    )
    return keep(dealt.groupBy("dim", "shard").applyInPandas(build, kind), "hnsw")


def nearest_neighbours(queries: DataFrame, index: DataFrame, search: Search = Search()) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's nearest rows by cosine, ties to smaller ids.

    ``queries`` (vec_id, embedding) skip the rows of their own id. Scores are the cosines of
    the vectors as given, in double precision. Queries that are null, zero or not finite, or
    have a length no row has, find nothing. Fewer rows than wanted give all there are.
    """
    asked = usable(queries).distinct().withColumn("dim", F.size("vector"))
    blocks = asked.agg(F.greatest(F.ceil(F.count("*") / search.block), F.lit(1))).scalar()
    dims = index.groupBy("dim").agg(F.max("shards").alias("shards"))
    shards = F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)
    placed = asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), blocks)).join(dims, "dim")
    placed = placed.withColumn("shard", F.explode(shards))
    offered = index.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))

    def look(asked: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        columns = ["query_id", "vec_id", "score"]
        if not len(asked) or not len(shard):
            return pd.DataFrame([], columns=columns)
        row = shard.iloc[0]
        points = np.frombuffer(row["vectors"], dtype=np.float64).reshape(-1, int(row["dim"]))
        n = len(points)
        links = [np.frombuffer(b, dtype=np.int32).reshape(n, -1) for b in row["links"]]
        graph = Graph(_unit(points), links, int(row["entry"]))
        first = np.r_[0, np.cumsum(row["id_counts"])]
        ids = np.asarray(row["ids"])
        wanted = np.stack(asked["vector"].to_list())
        out = []
        for own, query, unit in zip(asked["vec_id"].tolist(), wanted, _unit(wanted)):
            near = graph.search(unit, search.breadth)
            # The own vector may be among them, so one more than wanted.
            found = sorted(((cosine(query, points[v]), v) for v in near), key=lambda x: -x[0])
            rows = [(-s, int(i)) for s, v in found for i in ids[first[v] : first[v + 1]] if i != own]
            out += [(own, i, -s) for s, i in sorted(rows)[: search.neighbours]]
        return pd.DataFrame(out, columns=columns)

    keys, tasks = ["dim", "block", "shard"], _tasks(queries)
    placed, offered = placed.repartition(tasks, *keys), offered.repartition(tasks, *keys)
    pairs = placed.groupBy(*keys).cogroup(offered.groupBy(*keys))
    found = pairs.applyInPandas(look, "query_id long, vec_id long, score double").distinct()
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= search.neighbours)
    return ranked.select("query_id", "rank", "vec_id", "score")


def cosine(a: np.ndarray, b: np.ndarray) -> float:
    a, b = a / np.abs(a).max(), b / np.abs(b).max()
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def neighbour_report(embeddings: DataFrame, every: int = 50, search: Search = Search()) -> DataFrame:
    """Neighbours of the rows whose id ``every`` divides, among all rows."""
    rows = embeddings.select("vec_id", "embedding")
    index = build_index(rows, search)
    return nearest_neighbours(rows.where(F.col("vec_id") % every == 0), index, search)
