"""Passages repeated only among rows that share a key or have none."""

from riskweave.llm import spans

from .data import documents, prose


def test_passages_of_rows_without_own_keys(spark):
    passage, other = prose(60, 1), prose(60, 2)
    rows = [(None, f"{prose(30, 10 + i)}\n{passage}\n{prose(30, 20 + i)}") for i in range(4)]
    rows += [(None, prose(50, 40))] * 3 + [(None, None), (None, "")]
    rows += [(5, f"{prose(30, 50 + i)}\n{other}") for i in range(3)] + [(6, other)] + [(7, prose(50, 60))] * 2
    docs = documents(spark, [(k, t, "en", "s", 1) for k, t in rows]).repartition(4)
    found = [(r["doc_id"], r["text"]) for r in spans.remove_repeated_spans(docs).collect()]
    assert len(found) == len(rows)
    texts = lambda key: [t for k, t in found if k == key and t]
    assert sum(passage in t for t in texts(None)) == 1 and sum(prose(50, 40) in t for t in texts(None)) == 1
    assert all(sum(prose(30, n + i) in t for t in texts(None)) == 1 for n in (10, 20) for i in range(4))
    assert sum(other in t for t in texts(5)) == 1 and texts(6) == [] and len(texts(5)) == 3
    assert texts(7) == [prose(50, 60)] * 2  # repeated rows


def test_marks_are_bounded_by_the_text(spark):
    passage = prose(60, 1)
    rows = [(None, f"{passage}\n{prose(60, 100 + i % 20)}") for i in range(60)]
    docs = spans.told_apart(documents(spark, [(k, t, "en", "s", 1) for k, t in rows]), "doc_id", "text")
    runs = spans.run_table(docs, "doc_id", "text", spans.RunRule())
    assert runs.select("id", "row").distinct().count() == 60
