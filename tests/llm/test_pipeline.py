"""The pipeline's stages, each against a brute-force version on its own input."""

import corpus_pipeline
from strata.llm import pii

from .helpers import SMALL, frame, odd_rows
from .test_minhash import brute_components, brute_sets
from .test_text_operators import plain_base, plain_matches


def test_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language ID", "MinHash near-dedup", "benchmark decontamination", "PII",
                            "BPE encoding and decoding"]
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}

    kept = corpus_pipeline.language(spark, docs, SMALL)
    assert kept.columns == docs.columns and kept.count() == len(rows)  # all of them have words

    kept = corpus_pipeline.near_copies(spark, docs, SMALL)
    assert kept.columns == docs.columns
    best = brute_components(list(rows), brute_sets(rows.values()))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(best.values()))

    kept = corpus_pipeline.benchmark_passages(spark, docs, SMALL)
    assert kept.columns == docs.columns
    items = [tuple(r) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {d for d, _ in plain_matches(rows.items(), items)}
    assert gone and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(rows) - gone)

    kept = corpus_pipeline.personal_data(spark, docs, SMALL)
    assert kept.columns == docs.columns
    for r in kept.collect():
        assert plain_base(r["text"]) == [] or pii.base_spans(rows[r["doc_id"]])
        if not plain_base(rows[r["doc_id"]]):
            assert r["text"] == rows[r["doc_id"]]


def test_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert out.columns == ["doc_id", "n_tokens", "ids", "decoded"]
    assert 100 < out.count() < 200


def test_stages_take_odd_and_empty_tables(spark):
    for rows in (odd_rows(), []):
        docs = frame(spark, rows)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SMALL)
            assert out.columns == docs.columns, name
            out.collect()
        assert len(corpus_pipeline.tokens(spark, docs, SMALL).collect()) == len(rows)
