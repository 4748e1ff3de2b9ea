"""The pipeline: stages keep the columns, and each keeps what its operator says, by brute force."""

import corpus_pipeline
from oddsframe.llm import queries
from tests.conftest import SF_SMALL


def test_registered():
    for n in range(1, 11):
        assert sum(q.startswith(f"op{n}_") for q in queries.QUERIES) == 1
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "quality", "near_dedup", "packing"]


def test_stages_follow_their_operators(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r.doc_id: r for r in docs.collect()}
    toxic = {r.doc_id for r in queries.QUERIES["op5_toxicity_knn"](spark, SF_SMALL).collect() if r.predicted}
    first = corpus_pipeline.toxicity(spark, docs, SF_SMALL)
    assert first.columns == docs.columns
    kept = first.collect()
    assert {r.doc_id for r in kept} == set(rows) - toxic and all(rows[r.doc_id] == r for r in kept)
    good = {r.doc_id for r in queries.QUERIES["op2_quality_pu"](spark, SF_SMALL).collect() if r.predicted}
    assert {r.doc_id for r in corpus_pipeline.quality(spark, docs, SF_SMALL).collect()} == good
    near = queries.QUERIES["op4_simhash_bktree"](spark, SF_SMALL).collect()
    third = corpus_pipeline.near_dedup(spark, docs, SF_SMALL)
    assert third.columns == docs.columns
    assert sorted(r.doc_id for r in third.collect()) == sorted({r.component_id for r in near})
    pieces = corpus_pipeline.run(spark, SF_SMALL).collect()
    assert {r.doc_id for r in pieces} <= set(rows) - toxic and len(pieces) >= len({r.doc_id for r in pieces}) > 0


def test_empty_and_extra_columns(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").selectExpr("*", "1 as fingerprint", "2 as _key").limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_SMALL)
        assert docs.count() == 0 and "_key" in docs.columns
    assert corpus_pipeline.pack(spark, docs, SF_SMALL).count() == 0
