"""Near words, forms and roots against plain definitions."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from riskweave.llm import spelling
from riskweave.llm.queries import QUERIES

from .data import documents, edge_rows, prose


def one_edit(u, v):
    if len(u) > len(v):
        u, v = v, u
    if len(v) - len(u) > 1 or u == v:
        return False
    if len(u) == len(v):
        return sum(a != b for a, b in zip(u, v)) == 1
    return any(v[:k] + v[k + 1 :] == u for k in range(len(v)))


def expected(counts, ratio=5):
    out, form = [], {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, n in counts.items():
        best = min(near[w], key=lambda v: (-counts[v], v), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[w] = best
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, n, len(near[w]), form.get(w), counts.get(form.get(w)), root))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.select("word", "n", "n_near", "form", "form_n", "root").collect())


def crowd(seed, n=400):
    """Words that are near each other in many ways, repeated letters among them."""
    rng, words = random.Random(seed), {"a" * k for k in range(6, 12)} | {"abcabc" + "é" * k for k in range(4)}
    while len(words) < n:
        word = list(rng.choice(sorted(words)) if rng.random() < 0.8 else "".join(rng.choices("abé", k=rng.randint(6, 9))))
        at = rng.randrange(len(word))
        word[at : at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é", "z"])
        if len(word) >= 6:
            words.add("".join(word))
    return {w: rng.choice([5, 6, 30, 31, 200, 1000, 5000]) for w in sorted(words)}


@pytest.mark.parametrize("seed", range(5))
def test_scan_against_definition(seed):
    words = sorted(crowd(seed))
    found = {(words[i], words[j]) for i, j, _ in spelling.near_pairs(words)}
    assert found == {(u, v) for u in words for v in words if u < v and one_edit(u, v)}
    for i, j, place in spelling.near_pairs(words):
        assert words[i][:place] == words[j][:place] and words[i][place : place + 1] != words[j][place : place + 1]


@pytest.mark.parametrize("group", [0, 60, 1 << 15])
def test_forms_against_definition(spark, group):
    """Halved down to single places, in part, and not at all."""
    counts = crowd(11)
    df = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(5)
    assert rows_of(spelling.forms(df, group=group)) == expected(counts)


def test_long_way_to_the_root(spark):
    counts = {"b" * (6 + k): 5 * 6**k for k in range(20)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = rows_of(spelling.forms(df))
    assert found == expected(counts) and {r[5] for r in found} == {"b" * 25}


def test_query_against_definition(spark, tmp_path):
    texts = [(i, t) for i, t, *_ in edge_rows()] + [(i, prose(200, i) + " straße Straße ÉCOLE école x×÷yzabcd") for i in range(100, 160)]
    texts += [(None, "Alphabet alphabet alphabets"), (70, "alphabet " * 300), (71, "alphabett " * 9), (72, "w" * 3000 + " "), (73, ("w" * 2999 + " ") * 9)]
    texts += [(74 + i, "w" * 3000) for i in range(6)]
    documents(spark, [(i, t, "en", "s", 1) for i, t in texts]).repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    words = Counter()
    for i, text in texts:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    counts = {w: n for w, n in words.items() if len(w) >= 6 and n >= 5}
    found = rows_of(QUERIES["op12_spelling_forms"](spark, str(tmp_path)))
    assert found == expected(counts)
    assert any(r[3] for r in found) and any(len(r[0]) > 2000 for r in found)


def test_empty_and_null(spark):
    docs = spark.createDataFrame([], "words array<string>, word string")
    assert spelling.group_variants(docs, F.col("words")).collect() == []
    docs = spark.sql("SELECT CAST(NULL AS ARRAY<STRING>) AS words, 1 AS n UNION ALL SELECT array(), 2 UNION ALL SELECT array(NULL), 3")
    assert spelling.group_variants(docs, F.col("words")).collect() == []
    with pytest.raises(ValueError):
        spelling.forms(docs, ratio=1)
