"""Rows that share a key or have none are judged one by one."""

from riskweave.llm import decontaminate, ngram_join

from .data import documents, prose


def test_keep_one_by_row(spark):
    text, other, third = prose(80, 1), prose(80, 2), prose(80, 3)
    near = text + " end"
    rows = [
        (1, text), (None, near), (None, prose(80, 4)), (None, prose(80, 5)), (None, None), (None, ""),
        (7, text + " tail"), (7, other), (8, other + " tail"),
        (9, third), (9, third + " tail"), (None, prose(80, 6)), (None, prose(80, 6)),
    ]
    docs = documents(spark, [(k, t, "en", "s", 1) for k, t in rows]).repartition(3)
    kept = sorted([(r["doc_id"], r["text"]) for r in ngram_join.keep_one(docs).collect()], key=repr)
    nine = [x for x in kept if x[0] == 9]
    assert len(nine) == 1 and nine[0] in rows
    wanted = [(1, text), (7, other), (None, prose(80, 4)), (None, prose(80, 5)), (None, prose(80, 6)), (None, None), (None, "")]
    assert kept == sorted(wanted + nine, key=repr)


def test_remove_leaked_by_row(spark):
    item = prose(40, 50)
    rows = [(None, prose(30, 1) + " " + item), (None, prose(60, 2)), (None, None), (3, item), (3, prose(60, 3)), (4, prose(60, 4))]
    docs = documents(spark, [(k, t, "en", "s", 1) for k, t in rows])
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    kept = [(r["doc_id"], r["text"]) for r in decontaminate.remove_leaked(docs, benchmark).collect()]
    assert sorted(kept, key=repr) == sorted([rows[i] for i in (1, 2, 4, 5)], key=repr)
    assert decontaminate.find_leaks(docs, benchmark).columns == ["doc_id", "item_id", "start", "end", "edits", "n_bytes"]
