"""The sample that the quality model learns from."""

import pytest

from riskweave.llm import quality

from .data import documents, prose


def test_sample_skips_what_does_not_fit(spark, monkeypatch):
    learned = []
    monkeypatch.setattr(quality, "fit", lambda texts, grades, n: learned.append(sorted(zip(texts, grades.tolist()))))
    monkeypatch.setattr(quality, "SAMPLE_TEXTS", 8)
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 2000)
    texts = {i: "x" * 3000 if i % 2 else prose(5, i) for i in range(8)}
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in texts.items()])
    # most labels have no document
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id long, quality int, toxic int")
    quality.train(docs, labels)
    assert learned == [sorted((texts[i].encode(), 2) for i in range(0, 8, 2))]
    # a text that fits alone, but not beside the others, leaves room for smaller ones
    learned.clear()
    monkeypatch.setattr(quality, "SAMPLE_BYTES", 600)
    texts = {i: "x" * 500 if i < 3 else f"small {i}" for i in range(8)}
    quality.train(documents(spark, [(i, t, "en", "s", 1) for i, t in texts.items()]), labels)
    assert len(learned[0]) == 6 and sum(len(t) for t, _ in learned[0]) <= 600


def test_labels_without_documents_are_an_error(spark):
    docs = documents(spark, [(1, prose(20, 1), "en", "s", 1)])
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 1)], "doc_id long, quality int, toxic int")
    with pytest.raises(ValueError, match="no document"):
        quality.train(docs, labels)
    assert not quality.train(docs, labels.limit(0)).thresholds.any()
    assert not quality.train(documents(spark, []), labels).thresholds.any()
