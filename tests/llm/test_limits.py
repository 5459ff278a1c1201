"""Limits of the quality rules."""

from __future__ import annotations

import corpus_pipeline
from shelflens.llm import repetition_rules


def test_only_longer_ngrams_reject(spark):
    own = lambda name, n: " ".join(f"{name}{i:03}" for i in range(n))
    # A passage of 12 words twice in 175 words: 13.7% lie inside repeated n-grams.
    texts = [f"{own('p', 12)} {own('a', 100)} {own('p', 12)} {own('b', 51)}", own("c", 175)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    report = repetition_rules.repetition_report(docs, repetition_rules.FALLING).where("doc_id = 0").first()
    assert not report.base_failed and report.dup_5gram_share <= repetition_rules.FALLING.ngrams[5]
    assert report.dup_10gram_share > repetition_rules.FALLING.ngrams[10]
    assert [r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, "").collect()] == [1]
