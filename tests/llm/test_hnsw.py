from __future__ import annotations

import numpy as np
import pytest

from vendaval.llm.hnsw import Search, build_index, nearest_neighbours, neighbour_report


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def exact(rows, query, k=5):
    ids = np.array([i for i, _ in rows])
    points = np.array([v for _, v in rows], dtype=np.float64)
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    scores = points @ points[np.flatnonzero(ids == query)[0]]
    order = [j for j in np.lexsort((ids, -scores)) if ids[j] != query][:k]
    return [(int(ids[j]), float(scores[j])) for j in order]


def test_recall_over_several_shards(spark):
    chance = np.random.default_rng(8)
    centres = chance.normal(size=(40, 16))
    rows = [(i, (centres[i % 40] + 0.3 * chance.normal(size=16)).astype(np.float32).tolist()) for i in range(2000)]
    found = neighbour_report(frame(spark, [(*r, 0) for r in rows]), 50, Search(shard=300)).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(got) == set(range(0, 2000, 50))
    hits = 0
    for query, own in got.items():
        wanted = exact(rows, query)
        hits += len({i for i, _ in own} & {i for i, _ in wanted})
        assert own == sorted(own, key=lambda x: (-x[1], x[0])) and len(own) == 5
        scores = dict(exact(rows, query, 2000))
        assert all(s == pytest.approx(scores[i], abs=1e-12) for i, s in own)
    assert hits / (5 * len(got)) > 0.95


def test_whole_table_recall(spark, sf):
    table = spark.read.parquet(f"{sf}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    found = neighbour_report(table).collect()
    queries = {r.query_id for r in found}
    hits = sum(len({r.vec_id for r in found if r.query_id == q} & {i for i, _ in exact(rows, q)}) for q in queries)
    assert queries == {i for i, _ in rows if i % 50 == 0} and hits / (5 * len(queries)) >= 0.9


def test_odd_vectors(spark):
    rows = [(i, [1.0, 0.0], 0) for i in range(0, 400)]  # one very common vector
    rows += [(i, [1.0, 0.001 * i], 0) for i in range(400, 420)]
    rows += [(500, None, 0), (550, [0.0, 0.0], 0), (600, [1.0, float("nan")], 0), (650, [1.0, None], 0), (None, [1.0, 1.0], 0)]
    rows += [(700, [float("inf"), 1.0], 0), (750, [], 0), (800, [1.0, 2.0, 3.0], 0), (0, [1.0, 0.0], 0)]
    found = neighbour_report(frame(spark, rows), 50).collect()
    by = {}
    for r in sorted(found, key=lambda r: r.rank):
        by.setdefault(r.query_id, []).append(r.vec_id)
    assert set(by) == {*range(0, 400, 50), 400}
    # Equal vectors by smaller id, never the own.
    assert by[0] == [1, 2, 3, 4, 5] and by[50] == [0, 1, 2, 3, 4]
    assert by[400] == [401, 402, 403, 404, 405]


def test_few_and_no_rows(spark):
    found = neighbour_report(frame(spark, [(0, [1.0, 2.0], 0), (1, [2.0, 1.0], 0)])).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in found] == [(0, 1, 1)]
    assert neighbour_report(frame(spark, [])).collect() == []
    index = build_index(frame(spark, [(1, [1.0, 0.0], 0), (2, [0.0, 1.0], 0)]))
    asked = frame(spark, [(9, [3.0, 0.1], 0), (10, [1.0, 2.0, 3.0], 0)])
    assert [(r.query_id, r.vec_id) for r in nearest_neighbours(asked, index).orderBy("rank").collect()] == [(9, 1), (9, 2)]
