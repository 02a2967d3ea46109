from __future__ import annotations

import corpus_pipeline
from vendaval.llm.shared import keep


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = keep(stage(spark, docs, sf), "stage")
        ids = {r.doc_id for r in docs.select("doc_id").collect()}
        counts.append(docs.count())
        if number < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns, name
        if number == 0:
            good = [i for i, q in truth.items() if q == 1]
            assert sum(i in ids for i in good) / len(good) > 0.97
        if number in (1, 2):
            assert counts[-1] == len(ids)
    assert counts[0] > counts[1] > counts[2] > counts[3]
    assert set(docs.columns) == {*columns, "shard", "slot"}
    rows = docs.select("doc_id", "shard", "slot").collect()
    for shard in range(corpus_pipeline.SHARDS):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))


def test_run_repeats_itself(spark, sf):
    once = corpus_pipeline.run(spark, sf)
    again = corpus_pipeline.run(spark, sf)
    assert once.exceptAll(again).count() == again.exceptAll(once).count() == 0


def test_empty_documents(spark, documents, sf):
    docs = documents([])
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    assert docs.collect() == []


def test_odd_rows_with_clashing_columns(spark, documents, sf, odd_rows):
    """Every stage keeps columns of any name and all rows whose id is beyond 2^53."""
    rows = odd_rows + [(i, f"Some sentence number {i}. It says {i * i} and {i % 7}. " * 6) for i in range(100, 140)]
    far = [(1 << 60) + i for i in (1, 3, 5)]
    docs = documents(rows + [(i, f"Far away lies {i}, and {i % 11} words of it. " * 5) for i in far], clashing=True)
    for name, stage in corpus_pipeline.STAGES:
        docs = keep(stage(spark, docs, sf), "stage")
        ids = [r.doc_id for r in docs.select("doc_id").collect()]
        assert set(ids) <= {r[0] for r in rows} | set(far), name
    assert {"row", "key", "copies", "shard", "slot"} <= set(docs.columns)
