from __future__ import annotations

import hashlib
import math
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from vendaval.llm import importance as op
from vendaval.llm.sql import importance_sql

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain_buckets(text, grams, buckets):
    w = plain_words(text)
    runs = [" ".join(w[i : i + n]) for n in range(1, grams + 1) for i in range(len(w) - n + 1)]
    return [zlib.crc32(r.encode()) % buckets for r in runs]


def brute(rows, target, draw):
    """(doc_id, n_words, n_features, weight, score, rank) by the definition, in any order."""
    own = [plain_buckets(t, draw.grams, draw.buckets) for _, t in rows]
    aim = [b for t in target for b in plain_buckets(t, draw.grams, draw.buckets)]
    s = np.bincount([b for o in own for b in o], minlength=draw.buckets)
    t = np.bincount(np.array(aim, dtype=np.int64), minlength=draw.buckets)
    gain = [
        math.floor(1000 * math.log((t[b] + 1) * (int(s.sum()) + draw.buckets) / ((s[b] + 1) * (len(aim) + draw.buckets))))
        for b in range(draw.buckets)
    ]
    out = []
    for (doc_id, text), o in zip(rows, own):
        weight = sum(gain[b] for b in o) // len(o) if o else 0
        h = int(hashlib.sha256(f"{draw.seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(plain_words(text)), len(o), weight, score])
    can = sorted(
        (r for r in out if r[1] >= draw.least),
        key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[1]),
    )
    ranks = {}
    for place, r in enumerate(can, 1):
        ranks.setdefault(id(r), place if place <= draw.percent * len(can) // 100 else None)
    return [(*r, ranks.get(id(r))) for r in out]


def as_rows(frame):
    columns = ["doc_id", "n_words", "n_features", "weight", "score", "rank"]
    return [tuple(r[c] for c in columns) for r in frame.select(columns).collect()]


def in_order(rows):
    return sorted(rows, key=lambda r: tuple((v is None, v or 0) for v in r))


def test_crcs_are_the_usual_ones():
    values = ["", "a", "b", "ab", "é", "日本語", "x" * 63, "y" * 64, "z" * 65, "w" * 100_000, "a"]
    for kind in (pa.string(), pa.large_string(), pa.binary(), pa.large_binary()):
        found = op.crc32_all(pa.array([v.encode() if "binary" in str(kind) else v for v in values], kind))
        assert found.tolist() == [zlib.crc32(v.encode()) for v in values]
    sliced = pa.array(values).slice(3, 4)
    assert op.crc32_all(sliced).tolist() == [zlib.crc32(v.encode()) for v in values[3:7]]


@pytest.mark.parametrize("grams", [1, 2, 3, 4])
def test_buckets_are_those_of_each_run(grams):
    texts = ["", "One", "one TWO", None, "a b a b a b", "ÄÖ ä\x00x-9 [Z] `q`", "x", "x y z x y z w", "...", "end,start"]
    draw = op.Draw(grams=grams, buckets=97)
    buckets, owners, n_words = op.feature_buckets(pa.array(texts), draw)
    assert n_words.tolist() == [len(plain_words(t)) for t in texts]
    for i, text in enumerate(texts):
        assert sorted(buckets[owners == i].tolist()) == sorted(plain_buckets(text, grams, 97))


def test_odd_rows_by_the_definition(spark, documents, odd_rows):
    rows = odd_rows + [(100 + i, " ".join(f"w{(i * j) % 31}" for j in range(5 + i % 40))) for i in range(200)]
    rows += [(1 << 60, "far " * 30), ((1 << 60) + 1, "far " * 30), ((1 << 60) + 1, "far " * 30), (None, "w1 w2 " * 30)]
    target = ["w1 w2 w3", None, "", "one sentence here"]
    draw = op.Draw(buckets=503, least=10, percent=40)
    aim = spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string")
    found = op.importance(documents(rows, clashing=True), aim, draw)
    assert in_order(as_rows(found)) == in_order(brute(rows, target, draw))


def test_drawn_rows_keep_all_columns(spark, documents, odd_rows):
    rows = odd_rows + [(7, "same words again " * 9)] * 5 + [(8 + i, f"w{i} x y z " * 8) for i in range(30)]
    frame = documents(rows, clashing=True).repartition(5)
    aim = spark.createDataFrame([("w3 x y",)], "text string")
    draw = op.Draw(percent=60)
    drawn = op.resampled(frame, aim, draw)
    assert drawn.columns == frame.columns
    ranked = [r[0] for r in as_rows(op.importance(frame, aim, draw)) if r[5] is not None]
    assert sorted(r["doc_id"] for r in drawn.collect()) == sorted(ranked)


def test_empty_tables(spark, documents):
    aim = spark.createDataFrame([("some words",)], "text string")
    assert op.importance(documents([]), aim).collect() == []
    none = spark.createDataFrame([], "text string")
    rows = [(1, "a b c " * 10), (2, None)]
    draw = op.Draw(percent=100)
    assert in_order(as_rows(op.importance(documents(rows), none, draw))) == in_order(brute(rows, [], draw))


def test_equals_sql_on_the_whole_table(spark, sf):
    found = op.importance_report(*(spark.read.parquet(f"{sf}/{n}.parquet") for n in ("documents", "benchmark")))
    engine = duckdb.connect()
    for name in ("documents", "benchmark"):
        engine.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    columns = ["doc_id", "n_features", "weight", "score", "rank"]
    expected = engine.execute(f"SELECT {', '.join(columns)} FROM ({importance_sql()})").fetchall()
    assert in_order(tuple(r[c] for c in columns) for r in found.collect()) == in_order(expected)
    assert any(r[4] for r in expected)
