"""The pipeline's mixture takes whole documents, near the targets."""

import re
from collections import Counter

import corpus_pipeline
from kalends.llm import mixture
from tests.llm.cases import corpus, documents


def test_stage_takes_whole_documents(spark):
    rows = corpus()
    docs = documents(spark, rows)
    texts = {t for _, t, *_ in rows}
    got = corpus_pipeline.mixing(spark, docs, "").collect()
    assert got and all(r.text in texts for r in got)
    target, most, words = {}, Counter(), Counter()
    for r in mixture.plan(docs, others=("source",)).collect():
        target[r.source], most[r.source] = r.target, max(most[r.source], r["size"])
    for r in got:
        words[r.source] += len(re.findall(mixture.WORD, r.text))
    assert all(abs(words[s] - target[s]) <= most[s] / 2 + 1 for s in target)
    parts = mixture.copies(mixture.plan(docs, others=("text", "source"))).collect()
    assert any(r.text not in texts for r in parts)  # without ``whole`` one of them is cut


def test_queries_of_the_mix_stay_short(spark, capsys):
    """The driver plans a query anew after each of its shuffles: what ``plan`` and ``source_targets`` leave must not hold their earlier steps."""
    docs = documents(spark, corpus())
    sources = spark.createDataFrame([("=a", "a", 5), ("=b", "b", 9), ("", None, 2)], "key string, source string, source_size long")
    for left, most in ((mixture.plan(docs, others=("text", "source")), 8), (mixture.source_targets(sources, (1, 2, 3), 3), 4)):
        left.explain()
        plan = capsys.readouterr().out
        assert "Scan parquet" in plan and plan.count("Exchange") <= most
