from __future__ import annotations

import corpus_pipeline


def test_stages_keep_columns_and_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, counts = docs.columns, [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.cut(stage(spark, docs, sf_dir), "stage")
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] < counts[0]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert packed.select("doc_id").distinct().count() == counts[-1]
    text = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert not any(b["text"] in t for b in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() for t in text.values())
