"""Every stage takes all that the one before it kept, and its decisions take effect."""

from __future__ import annotations

import os

import pytest

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test data")


def test_stages(spark):
    import corpus_pipeline as pipeline
    from balcao.llm import exact_dedup, frames, mixing, quality_rules, queries, simhash

    documents = docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    kept = []
    for _, stage in pipeline.STAGES[:-1]:
        docs = frames.stored(stage(spark, docs, FOLDER))
        assert docs.schema == documents.schema
        kept.append(docs)
    assert {r["doc_id"] for r in kept[0].collect()} == {r["doc_id"] for r in quality_rules.assess(documents).filter("kept").collect()}
    assert {r["doc_id"] for r in kept[1].collect()} == {r["doc_id"] for r in exact_dedup.decisions(kept[0], keep="largest").filter("kept").collect()}
    near = simhash.near_groups(kept[1]).collect()
    assert {r["doc_id"] for r in kept[2].collect()} == {r["component_id"] for r in near}
    rates = {r["doc_id"]: r["copies"] for r in mixing.rates(kept[2], labels, queries.TARGETS).collect()}
    counts = {r["doc_id"]: r["count"] for r in kept[3].groupBy("doc_id").count().collect()}
    assert counts == {i: n for i, n in rates.items() if n}
    result = pipeline.run(spark, FOLDER)
    firsts = {r["doc_id"]: r["count"] for r in result.filter("start = 0").groupBy("doc_id").count().collect()}
    assert firsts == counts
