"""Line runs: levels, anti-joins and removal against a plain count of lines."""

import re
from collections import defaultdict

import pytest

from riskweave.llm import lines

from .data import documents, edge_rows, prose

BLANK = " \t\n\x0b\x0c\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(BLANK))


def expected(rows, min_chars=40, min_docs=5):
    """(id, text, n_lines, n_dropped) of rows (id, text); null ids are below all others."""
    holders = defaultdict(list)
    for i, text in rows:
        for k in {key(line) for line in (text or "").split("\n")}:
            if len(k) >= min_chars:
                holders[k].append(i)
    out = []
    for i, text in rows:
        all_lines, kept = (text or "").split("\n"), []
        for line in all_lines:
            own = holders.get(key(line), [])
            if len(own) < min_docs or i == max((x for x in own if x is not None), default=None):
                kept.append(line)
        out.append((i, text if len(kept) == len(all_lines) else "\n".join(kept), len(all_lines), len(all_lines) - len(kept)))
    return sorted(out, key=repr)


def rows_with_repeats():
    shared = ["  Shared line Ä number one, of fifty code points.\t", "a short one", "shared LINE Ä number one, of fifty code points."]
    texts = [(i, "\n".join([prose(12, i), shared[i % 3], shared[0] if i % 4 else "", prose(9, i % 7)])) for i in range(40)]
    return texts + [(i, t) for i, t, *_ in edge_rows()] + [(None, shared[0] + "\n" + shared[1])] * 3


@pytest.mark.parametrize("n", [1, 2, 5])
def test_against_counts(spark, n):
    rows = rows_with_repeats()
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows]).repartition(3)
    found = lines.remove_repeated_lines(lines.by_falling_id(docs, n))
    assert found.columns == ["doc_id", "text", "lang", "source", "n_chars", "n_lines", "n_dropped"]
    got = sorted((tuple(r) for r in found.select("doc_id", "text", "n_lines", "n_dropped").collect()), key=repr)
    assert got == expected(rows)


def test_first_batch_keeps(spark):
    """Without falling ids, the first batch that has a line keeps it."""
    line = "x" * 40
    batches = [spark.createDataFrame([(i, line)], "doc_id long, text string") for i in (3, 9, 1, 7, 5)]
    kept = lines.remove_repeated_lines(batches).filter("n_dropped = 0").collect()
    assert [r["doc_id"] for r in kept] == [3]


def test_levels(spark):
    """Runs are merged level by level, every line is in one run as new, and nothing is left behind."""
    before = {t.name for t in spark.catalog.listTables()}
    runs = lines.LineRuns(spark, fanout=2)
    for i in range(7):
        rows = [(10 * i + j, "\n".join(prose(12, k) for k in range(i + j))) for j in range(3)]
        runs.add(spark.createDataFrame(rows, "doc_id long, text string"))
        assert [len(level) for level in runs.levels] == [(i + 1) >> k & 1 for k in range(len(runs.levels))]
        known = [{(r["_h1"], r["_h2"]) for r in runs._read(run).filter("holder IS NOT NULL").collect()} for run in runs.runs()]
        assert len(set().union(*known)) == sum(map(len, known)) == i + 2
    assert runs.repeated(1).count() == 8
    runs.drop()
    assert {t.name for t in spark.catalog.listTables()} == before


def test_empty_and_clashing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert lines.remove_repeated_lines(lines.by_falling_id(docs)).collect() == []
    with pytest.raises(ValueError):
        lines.remove_repeated_lines([])
    clash = spark.sql("SELECT 'b' AS _id, 'x' AS text, 1 AS n_lines, 2 AS _r1, 3 AS holder, 4 AS _places, 5 AS `a.b`")
    found = lines.remove_repeated_lines([clash], id_col="_id").collect()
    assert [r.asDict() for r in found] == [{"_id": "b", "text": "x", "_r1": 2, "holder": 3, "_places": 4, "a.b": 5, "n_lines": 1, "n_dropped": 0}]
