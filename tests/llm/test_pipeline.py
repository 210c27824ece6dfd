"""The pipeline's stages keep columns and clean rows; the queries are registered with it."""

import corpus_pipeline
from tenura.llm.common import table

import __spark_entry__ as contract

TINY = "/root/testdata/sf0.001"


def test_stages_over_a_small_corpus(spark):
    docs = table(spark, TINY, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, TINY)
        assert out.columns == docs.columns and 0 < out.count() <= docs.count(), name
    assert corpus_pipeline.run(spark, TINY).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_registration():
    names = contract.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))
