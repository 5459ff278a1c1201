"""The threshold of the perplexity."""

from __future__ import annotations

import numpy as np

from shelflens.llm import kneser_ney


def test_threshold_is_the_quantile(spark):
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["ant", "bear", "cat", "dog", "elk"], 20)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(40)], "doc_id long, quality int")
    got = kneser_ney.judge_by_perplexity(docs, labels, quantile=0.5).collect()
    values = sorted(r.perplexity for r in got)
    assert {r.kept for r in got} == {True, False}
    assert all(values[19] <= r.threshold <= values[20] for r in got)
