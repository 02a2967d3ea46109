from __future__ import annotations

import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from vendaval.llm import lexical as op
from vendaval.llm.sql import search_sql

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
COLUMNS = ["item_id", "rank", "doc_id", "score"]


def plain_words(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return [w.translate(LOWER) for w in found]


def brute(documents, items, k=10):
    own = [(i, Counter(plain_words(t))) for i, t in documents]
    own = [(i, c, sum(c.values())) for i, c in own if c]
    n, total = len(own), sum(length for *_, length in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item_id, text in sorted(set(items), key=str):
        scores = []
        for doc_id, counts, length in own:
            m = 100 - 75 + (75 * length * n) // total
            score = 0
            for term in plain_words(text):
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, rank, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k], 1)]
    return out


def found(spark, documents, items, k=10):
    items = spark.createDataFrame(items, "item_id long, text string")
    rows = op.search(documents, items, op.Ranking(k=k)).collect()
    return sorted((tuple(r[c] for c in COLUMNS) for r in rows), key=str)


def made(seed, n):
    rng = random.Random(seed)
    vocabulary = [f"t{int(rng.paretovariate(0.7))}" for _ in range(400)]
    return [" ".join(rng.choices(vocabulary, k=rng.randint(0, 40))) for _ in range(n)]


def test_odd_rows_by_the_definition(spark, documents, odd_rows):
    far = 1 << 60
    rows = odd_rows + [(far + 1, "Another ÉTÉ été"), (far + 3, "another ÉTÉ été"), (far + 3, "another ÉTÉ été"), (None, "another")]
    items = [(1, "one sentence HERE, another"), (1, "one sentence HERE, another"), (1, "follows"), (2, None), (3, ""), (4, "absent"), (5, "été ÉTÉ another another")]
    expected = brute(rows, items)
    assert found(spark, documents(rows, clashing=True), items) == sorted(expected, key=str)


@pytest.mark.parametrize("filtered", [True, False])
def test_shards_and_blocks_do_not_show(spark, documents, monkeypatch, filtered):
    monkeypatch.setattr(op, "SHARD_ROWS", 37)
    monkeypatch.setattr(op, "BLOCK_TERMS", 150)
    monkeypatch.setattr(op, "FIRST_OPEN", 2)
    if not filtered:
        monkeypatch.setattr(op, "FILTER_BYTES", 0)
    texts = made(1, 300)
    # Copies tie at the k-th place, over shards and within them.
    rows = [(i, texts[i % 40] if i % 3 == 0 else t) for i, t in enumerate(texts)]
    items = list(enumerate(made(2, 40)))
    expected = sorted(brute(rows, items), key=str)
    assert found(spark, documents(rows).repartition(4), items) == expected


def test_intervals_find_the_best_and_leave_the_rest(spark):
    """Bounds are exact: the search opens fewer documents than match, and finds the k best."""
    rng = np.random.default_rng(3)
    n = 2000
    docs = [np.sort(rng.choice(n, size=s, replace=False)) for s in (1500, 700, 30, 4, 1)]
    impacts = [rng.integers(1, top, len(d)) for d, top in zip(docs, (20, 50, 900, 4000, 9000))]
    postings = op.Postings(docs, impacts, n)
    terms, times = np.arange(5), np.array([1, 2, 1, 1, 3])
    total = np.zeros(n, dtype=np.int64)
    for d, i, c in zip(docs, impacts, times):
        total[d] += c * i
    order = np.lexsort((np.arange(n), -total))[:10]
    best, scores, scored = postings.search(terms, times, 10)
    assert best.tolist() == order.tolist() and scores.tolist() == total[order].tolist()
    assert scored < 300
    assert postings.search(np.array([4]), np.array([1]), 10)[0].tolist() == docs[4].tolist()


def test_range_maxima():
    rng = np.random.default_rng(5)
    impacts = [rng.integers(0, 5, 50), rng.integers(0, 5, 13)]
    postings = op.Postings([np.arange(50), np.arange(13)], impacts, 50)
    for begin in range(63):
        for end in range(begin + 1, 51 if begin < 50 else 64):
            at = postings.greatest(np.array([begin]), np.array([end]))[0]
            assert at == begin + np.argmax(np.concatenate(impacts)[begin:end])


def test_empty_tables(spark, documents):
    assert found(spark, documents([]), [(1, "a")]) == []
    assert found(spark, documents([(1, None), (2, "...")]), [(1, "a")]) == []
    assert found(spark, documents([(1, "a")]), []) == []


def test_equals_sql_on_the_whole_table(spark, sf):
    frame = op.search(*(spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark")))
    engine = duckdb.connect()
    for name in ("documents", "benchmark"):
        engine.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    expected = engine.execute(f"SELECT {', '.join(COLUMNS)} FROM ({search_sql()})").fetchall()
    assert sorted(tuple(r[c] for c in COLUMNS) for r in frame.collect()) == sorted(expected)
    assert len(expected) > 100
