from __future__ import annotations

import random

import pytest

from vendaval.llm.toxicity import maximal_segments, score_toxicity


def by_recursion(scores, base=0):
    """Maximal segments by definition: the best one, then the rest on both sides of it."""
    best = max(
        ((sum(scores[i:j]), -(j - i), -i) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)),
        default=(0, 0, 0),
    )
    if best[0] <= 0:
        return []
    i, j = -best[2], -best[2] - best[1]
    left, right = by_recursion(scores[:i], base), by_recursion(scores[j:], base + j)
    return [*left, (base + i, base + j - 1, best[0]), *right]


@pytest.mark.parametrize("seed", range(60))
def test_segments(seed):
    chance = random.Random(seed)
    # Sums of different powers of two keep segments from being equally good.
    scores = [chance.choice([-1.5, -1.5, chance.uniform(0.5, 4)]) for _ in range(chance.randrange(25))]
    at = [i for i, s in enumerate(scores) if s > 0]
    found = maximal_segments(at, [scores[i] for i in at], -1.5)
    assert [(b, e) for b, e, _ in found] == [(b, e) for b, e, _ in by_recursion(scores)]
    assert [s for *_, s in found] == pytest.approx([s for *_, s in by_recursion(scores)])


@pytest.fixture(scope="module")
def made(documents, spark):
    """Texts of which every fourth holds a few bad words, labelled for four fifths."""
    chance = random.Random(4)
    rows, labels = [], []
    for i in range(800):
        words = [f"w{chance.randrange(400)}" for _ in range(60)]
        if i % 4 == 0:
            at = chance.randrange(50)
            words[at : at + 3] = chance.choices(["vile", "rotten", "nasty", "foul" + chance.choice("abcdefgh")], k=3)
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    return documents(rows), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxic_texts_are_found(made):
    rows = score_toxicity(*made).collect()
    assert len(rows) == 800
    held = [r for r in rows if r.held_out]
    assert len(held) > 100 and sum(r.predicted == (r.doc_id % 4 == 0) for r in held) / len(held) > 0.97
    texts = {r.doc_id: r.text.split() for r in made[0].collect()}
    inside = [w for r in rows for p in r.passages for w in texts[r.doc_id][p["first"] : p["last"] + 1]]
    assert sum(not w.startswith("w") for w in inside) > 0.7 * len(inside) > 0
    assert {(r.doc_id, r.score) for r in score_toxicity(made[0].repartition(3), made[1]).collect()} == {(r.doc_id, r.score) for r in rows}


def test_odd_rows(made, documents, odd_rows, spark):
    docs = documents([*odd_rows, *[(r.doc_id + 1000, r.text) for r in made[0].limit(200).collect()]], clashing=True)
    labels = made[1].selectExpr("doc_id + 1000 as doc_id", "toxic")
    labels = labels.unionByName(spark.createDataFrame([(None, 1), (4, None)], "doc_id long, toxic int"))
    rows = score_toxicity(docs, labels).collect()
    assert len(rows) == len(odd_rows) + 200 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 5)}) == 1


def test_without_labels(documents, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in score_toxicity(documents([(1, "a b"), (2, None)]), none).collect()] == [0.5, 0.5]
    assert score_toxicity(documents([]), none).collect() == []


def test_whole_table(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    rows = score_toxicity(docs, labels).collect()
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    held = [(truth[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(t == p for t, p in held) / len(held) > 0.9
