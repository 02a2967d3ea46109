from __future__ import annotations

import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from vendaval.llm.components import connected_components
from vendaval.llm.neardup import (
    _links,
    fingerprint_links,
    keep_one,
    near_duplicate_report,
    near_duplicates,
    text_fingerprint,
)


def groups(n, links):
    parent = list(range(n))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return [root(i) for i in range(n)]


def bits(text):
    words = [w for w in "".join(c.lower() if c.isascii() else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "Two Words", "a b c", "A\tb\nC d É a b c " * 9])
def test_fingerprint(text):
    assert text_fingerprint(text) == bits(text)


def test_whole_table_against_all_pairs(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.doc_id: r for r in near_duplicate_report(docs).collect()}
    ids = sorted(found)
    prints = np.array([int(found[i].fingerprint, 16) for i in ids], dtype=np.uint64)
    for r in docs.limit(40).collect():
        assert int(found[r.doc_id].fingerprint, 16) == bits(r.text)
    links = [
        (i, int(j) + i + 1)
        for i in range(len(ids))
        for j in np.flatnonzero(np.bitwise_count(prints[i] ^ prints[i + 1 :]) <= 2)
    ]
    assert [found[i].component_id for i in ids] == [ids[g] for g in groups(len(ids), links)]


def test_links_of_dense_fingerprints(spark):
    chance = random.Random(5)
    # Few free bits in all bytes, so that keys hold many and chains are long.
    values = {sum(chance.getrandbits(1) << (8 * b + chance.randrange(2)) for b in range(8)) for _ in range(300)}
    values = sorted(v - (1 << 64) if v >> 63 else v for v in values)
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    place = {v: i for i, v in enumerate(values)}
    rows = fingerprint_links(frame).collect()
    assert all(bin((r.a ^ r.b) & (1 << 64) - 1).count("1") <= 2 for r in rows)
    near = [(i, j) for i, j in combinations(range(len(values)), 2) if bin((values[i] ^ values[j]) & (1 << 64) - 1).count("1") <= 2]
    assert groups(len(values), [(place[r.a], place[r.b]) for r in rows]) == groups(len(values), near)


@pytest.mark.parametrize("n", [2, 8, 9, 64, 65, 3000])
def test_links_within_a_key(n):
    free = np.random.default_rng(n).choice(1 << 16, n, replace=False)
    found = _links(free, 2)
    apart = np.bitwise_count(free[:, None] ^ free[None, :]) <= 2
    near = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(apart, 1)))]
    assert set(found) <= set(near) and groups(n, found) == groups(n, near)
    assert len(found) < n


def test_components(spark):
    chance = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 180)] + [(chance.randrange(200, 300), chance.randrange(200, 300)) for _ in range(90)]
    found = connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    wanted = groups(300, links)
    assert {r.node: r.component for r in found} == {i: wanted[i] for i in {x for p in links if p[0] != p[1] for x in p}}
    assert len(found) == len({r.node for r in found})
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_odd_rows(documents, odd_rows):
    rows = near_duplicates(documents(odd_rows, clashing=True)).collect()
    assert len(rows) == len(odd_rows)
    blank = [r.component_id for r in rows if r.fp == 0]
    assert blank == [1, 1, 1, 1] and [r.component_id for r in rows if r.doc_id == 6] == [4]
    assert near_duplicates(documents([])).collect() == []


def test_stage_keeps_the_first_of_each_component(spark, documents, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    found = {r.component_id for r in near_duplicate_report(docs).collect()}
    kept = keep_one(docs)
    rows = kept.collect()
    assert kept.columns == docs.columns and sorted(r.doc_id for r in rows) == sorted(found)
    assert kept.exceptAll(docs).count() == 0 and len(rows) < docs.count()


def test_stage_keeps_one_of_near_copies(documents):
    chance = random.Random(1)
    text = [f"w{chance.randrange(900)}" for _ in range(3000)]
    other = [f"v{chance.randrange(900)}" for _ in range(300)]
    near = list(text)
    near[1500] = "changed"
    assert bin(bits(" ".join(text)) ^ bits(" ".join(near))).count("1") <= 2
    rows = [(9, " ".join(text)), (3, " ".join(near)), (5, " ".join(text).upper()), (6, " ".join(other))]
    kept = keep_one(documents(rows, clashing=True))
    assert sorted(r.doc_id for r in kept.collect()) == [3, 6]
    assert "fp" in kept.columns and "key" in kept.columns


def test_stage_on_odd_rows(documents, odd_rows):
    kept = keep_one(documents(odd_rows)).collect()
    assert sorted((str(r.doc_id), r.text[:9] if r.text else r.text) for r in kept) == sorted(
        [("None", "some text"), ("1", ""), ("3", "word0 and"), ("4", "One sente"), ("4", "The same ")]
    )
    assert keep_one(documents([])).collect() == []
