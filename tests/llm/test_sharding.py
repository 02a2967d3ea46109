from __future__ import annotations

import math
import struct
import zlib
from collections import Counter

import pytest
import xxhash
from pyspark.sql import functions as F

from vendaval.llm.sharding import SEED, assign_shards, shard_of, shard_report, write_shards


def test_report_on_odd_rows(documents, odd_rows):
    rows = shard_report(documents(odd_rows, clashing=True), 4).collect()
    assert len(rows) == len(odd_rows)
    wanted = Counter(
        (i, len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode())) for i, t in odd_rows
    )
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == wanted
    for shard in range(4):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r.doc_id == 4}) == 1


def test_one_more_shard_takes_only_for_itself(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    moved = shard_report(keys, 8).where("shard <> grown_shard")
    found = moved.groupBy("grown_shard").count().collect()
    assert [r.grown_shard for r in found] == [8]
    assert abs(found[0]["count"] - 20_000 / 9) < 250


def test_shares_follow_weights(spark):
    shard = shard_of(F.col("id"), [1.0, 0.0, 3.0])
    counts = {r.s: r["count"] for r in spark.range(40_000).groupBy(shard.alias("s")).count().collect()}
    assert set(counts) == {0, 2} and abs(counts[2] - 30_000) < 600


def test_same_rows_same_places(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    once = {tuple(r) for r in shard_report(docs, 8).collect()}
    again = {tuple(r) for r in shard_report(docs.repartition(7), 8).collect()}
    assert once == again and len(once) == 1000


def test_empty_table_and_bad_weights(documents):
    assert assign_shards(documents([]), [1.0, 1.0]).collect() == []
    with pytest.raises(ValueError):
        shard_of(F.col("doc_id"), [0.0])


def test_written_shards_hold_all_rows(spark, documents, tmp_path):
    docs = documents([(i, f"text {i}") for i in range(50)])
    write_shards(docs, [1.0, 2.0], str(tmp_path / "out"), per_file=10)
    stored = spark.read.parquet(str(tmp_path / "out"))
    assert stored.select("doc_id").distinct().count() == stored.count() == 50
    assert (tmp_path / "out" / "shard=0").is_dir()


def plain_shard(key, weights):
    """The shard with the least -ln(u) / weight, u from xxHash64 over seed, shard and key, chained."""
    best = []
    for shard, weight in enumerate(weights):
        h = 42
        for value, kind in ((SEED, "<i"), (shard, "<i"), (key, "<q")):
            if value is not None:
                h = xxhash.xxh64_intdigest(struct.pack(kind, value), h)
        if weight > 0:
            best.append((-math.log(((h >> 11) + 0.5) / 2**53) / weight, shard))
    return min(best)[1]


@pytest.mark.parametrize("weights", [[1.0] * 8, [2.0, 0.0, 0.5, 1.0]])
def test_shards_by_the_definition(spark, weights):
    keys = [None, 0, 1, -5, 1 << 60, *range(100, 700)]
    rows = spark.createDataFrame([(k,) for k in keys], "doc_id long").select("doc_id", shard_of(F.col("doc_id"), weights).alias("s"))
    assert {r.doc_id: r.s for r in rows.collect()} == {k: plain_shard(k, weights) for k in keys}


def test_report_by_the_definition(spark, sf):
    rows = shard_report(spark.read.parquet(f"{sf}/documents.parquet"), 8).collect()
    assert all(r.shard == plain_shard(r.doc_id, [1.0] * 8) for r in rows)
    assert all(r.grown_shard == plain_shard(r.doc_id, [1.0] * 9) for r in rows)
