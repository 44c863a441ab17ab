"""Joins, searches and removals over a corpus, against brute force."""

import math
import random
import re
from collections import Counter, defaultdict
from itertools import islice

import pytest

import corpus_pipeline
from riskweave.llm import decontaminate, graph, ngram_join, search, spans

from .data import documents, edge_rows, prose


def shingles(text):
    words = [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode().lower()) if w]
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def changed(text, n, seed):
    rng, words = random.Random(seed), text.split()
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


def near_copies():
    """Groups of chains of changes, so that not all members of a group link with each other."""
    rows, key = list(edge_rows()), 100
    for group in range(6):
        text = prose(90, 1000 + group)
        for i in range(25):
            rows.append((key, text, "en", "s", 1))
            key += 1
            text = changed(text, 1 + i % 2, key)
    return rows


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, x in enumerate(sets):
        for j in range(i):
            y = sets[j]
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r[0])
    least = {g: min((k for k in keys if k is not None), default=None) for g, keys in groups.items()}
    return Counter((r[0], len(sets[i]), least[root(i)] if sets[i] else r[0]) for i, r in enumerate(rows))


def test_ngram_join_equals_all_pairs(spark, monkeypatch):
    rows = near_copies()
    docs = documents(spark, rows).repartition(5).selectExpr("*", "1 AS component_id", "2 AS n")
    found = ngram_join.near_duplicates(docs).collect()
    assert Counter(tuple(r) for r in found) == brute_components(rows)
    assert ngram_join.near_duplicates(documents(spark, [])).count() == 0


def test_keep_one_of_each_component(spark):
    rows = near_copies()
    kept = [r["doc_id"] for r in ngram_join.keep_one(documents(spark, rows)).collect()]
    wanted = {c if c is not None else k for k, _, c in brute_components(rows)}
    assert set(kept) == wanted | {None}


def test_components(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, rng.randrange(101, 140)) for _ in range(50)] + [(200, 200)]
    found = {r["node"]: r["label"] for r in graph.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {**{i: 0 for i in range(61)}, **{n: 100 for e in edges[60:110] for n in e}}


def test_leaks_by_bands(spark):
    items = [(i, prose(35, 500 + i)) for i in range(12)] + [(90, None), (91, ""), (92, "short")]
    rng, rows, planted = random.Random(8), list(edge_rows()), set()
    for key in range(100, 160):
        text, item = prose(120, key), items[rng.randrange(12)]
        if key % 2:
            passage = list(item[1].upper().replace(" ", " \n "))
            for _ in range(key % 9):
                passage[rng.randrange(len(passage))] = "q"
            text = text[:200] + " " + "".join(passage) + " " + text[200:]
            planted.add((key, item[0]))
        rows.append((key, text, "en", "s", 1))
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    found = decontaminate.find_leaks(documents(spark, rows).selectExpr("*", "1 AS item_id"), benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == planted
    kept = decontaminate.remove_leaked(documents(spark, rows), benchmark)
    assert kept.count() == len(rows) - len(planted)
    assert decontaminate.find_leaks(documents(spark, []), benchmark).count() == 0
    assert decontaminate.find_leaks(documents(spark, rows), benchmark.limit(0)).count() == 0


def test_banded_distance_equals_full_table():
    def full(item, text):
        row = [0] * (len(text) + 1)
        for i, a in enumerate(item, 1):
            new = [i]
            for j, b in enumerate(text, 1):
                new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
            row = new
        return min(row)

    rng = random.Random(6)
    for _ in range(150):
        item = bytes(rng.choice(b"abc") for _ in range(rng.randint(1, 12)))
        text = bytes(rng.choice(b"abc") for _ in range(rng.randint(0, 20)))
        found = decontaminate.banded_distance(item, text, -len(item), len(text), 99)
        assert found[0] == full(item, text)
        assert full(item, text[found[1] : found[2]]) == found[0]


def brute_search(rows, queries, k):
    texts = [(key, Counter(re.findall(rb"[a-z0-9\x80-\xff]+", (t or "").lower().encode()))) for key, t, *_ in rows]
    n, mean = len(texts), sum(sum(c.values()) for _, c in texts) / len(texts)
    df = Counter(t for _, c in texts for t in c)
    out = set()
    for q, c in texts:
        if q not in queries:
            continue
        best = {}
        for d, e in texts:
            size = sum(e.values())
            score = sum(
                times * math.log1p((n - df[t] + 0.5) / (df[t] + 0.5)) * e[t] * 2.2 / (e[t] + 1.2 * (0.25 + 0.75 * size / mean))
                for t, times in c.items() if t in e
            )
            if score > 0:
                best[d] = max(best.get(d, 0), score)
        ranked = sorted(best.items(), key=lambda x: (-round(x[1], 9), x[0]))[:k]
        out |= {(q, d, i, round(s, 6)) for i, (d, s) in enumerate(ranked, 1)}
    return out


def test_top_k_equals_all_scores(spark, monkeypatch):
    rows = [(i, prose(10 + i % 40, i), "en", "s", 1) for i in range(300)] + [(301, None, None, None, None), (302, "", "en", "s", 0)]
    docs = documents(spark, rows)
    found = search.top_k(docs.repartition(3), docs.filter("doc_id % 50 = 0 OR doc_id > 300").selectExpr("*", "1 AS score"), k=7)
    got = {(r["query_id"], r["doc_id"], r["rank"], round(r["score"], 6)) for r in found.collect()}
    assert got == brute_search(rows, {0, 50, 100, 150, 200, 250, 301, 302}, 7)
    assert search.top_k(documents(spark, []), docs).count() == 0
    assert search.top_k(documents(spark, edge_rows()), documents(spark, edge_rows())).filter("doc_id = 3").count() > 0


def brute_spans(rows, rule):
    def runs(text):
        starts = spans.sentence_starts(text) if text else []
        parts = [" ".join(text[a:b].lower().split()) for a, b in zip(starts, [*starts[1:], len(text or "")])]
        size = [len(p.split()) for p in parts]
        fits = lambda a, b: b - a >= rule.sentences and sum(size[a:b]) >= rule.words
        out = {(a, a + 1) for a in range(len(parts)) if size[a] >= rule.single}
        for i in range(len(parts)):
            out |= set(islice(((i, b) for b in range(i, len(parts) + 1) if fits(i, b)), 1))
            out |= set(islice(((a, i + 1) for a in range(i, -1, -1) if fits(a, i + 1)), 1))
        return parts, [(a, b, tuple(parts[a:b])) for a, b in sorted(out)]

    order = lambda k: (k is None, k or 0)
    first = {}
    for key, text, *_ in rows:
        for _, _, run in runs(text)[1]:
            first[run] = min(first.get(run, order(key)), order(key))
    out = []
    for key, text, *_ in rows:
        parts, found = runs(text)
        gone, seen = set(), set()
        for a, b, run in found:
            if run in seen or first[run] < order(key):
                gone |= set(range(a, b))
            seen.add(run)
        out.append((key, len(parts), len(gone)))
    return Counter(out)


def test_repeated_spans(spark):
    passage, rows = prose(60, 77), list(edge_rows())
    for key in range(100, 130):
        text = prose(80, key)
        rows.append((key, f"{text}\n{passage}\n{prose(30, key + 50)}" if key % 3 == 0 else text, "en", "s", 1))
    rows.append((140, "\n".join([prose(25, 9)] * 3), "en", "s", 1))
    docs = documents(spark, rows).selectExpr("*", "1 AS n_removed", "2 AS h", "3 AS id")
    found = spans.remove_repeated_spans(docs.repartition(4))
    assert Counter((r["doc_id"], r["n_sentences"], r["n_removed"]) for r in found.collect()) == brute_spans(rows, spans.RunRule())
    kept = {r["doc_id"]: r["text"] for r in found.collect()}
    assert passage in kept[102] and not any(passage[:40] in (kept[k] or "") for k in range(103, 130))
    assert kept[2] is None and kept[1] == ""
    assert spans.remove_repeated_spans(documents(spark, [])).count() == 0


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = corpus_pipeline.stored(out)
        assert 0.5 * left <= docs.count() <= left, name
        left = docs.count()
    last = corpus_pipeline.STAGES[-1][1](spark, docs, sf_dir)
    assert last.count() == left and last.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    assert decontaminate.find_leaks(docs, item).count() == 0


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=lambda f: f.__name__)
def test_pipeline_stage_on_edge_rows(spark, sf_dir, stage):
    for rows in (edge_rows(), []):
        assert stage(spark, documents(spark, rows), sf_dir).count() <= len(rows)
