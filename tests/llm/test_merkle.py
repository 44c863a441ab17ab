"""Hash trees: roots, witnesses and folding against a tree built level by level in plain Python."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from riskweave.llm import merkle
from riskweave.llm.queries import QUERIES

from .data import documents, edge_rows


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def reduced(nodes):
    """Root and, per node, its siblings as (before, after) level by level."""
    paths, where = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, groups = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k in range(len(run)):
                for i in where[at + k]:
                    paths[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(H("".join(run)))
            groups.append([i for w in where[at : at + 8] for i in w])
        nodes, where = above, groups
    return nodes[0], paths


def expected(rows):
    """(doc_id, leaf, subroot, root, proof, folded, verified) of rows (doc_id, source, lang, n_chars, text)."""
    trees = {}
    for row in rows:
        trees.setdefault(row[2], []).append(row)
    order = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    built = {}
    for lang in order:
        trees[lang].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        built[lang] = reduced([leaf(r) for r in trees[lang]])
    root, tops = reduced([built[lang][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for row, path in zip(trees[lang], built[lang][1]):
            path = path + tops[k]
            changed = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                changed = (*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4]))
            node = leaf(changed)
            for before, after in path:
                node = H(before + node + after)
            out.append((row[0], leaf(row), built[lang][0], root, H("".join(b + a for b, a in path)), node, node == root))
    return sorted(out, key=repr)


def found(spark, tmp_path, rows):
    docs = documents(spark, [(i, text, lang, source, n) for i, source, lang, n, text in rows])
    docs.repartition(3).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, QUERIES["op11_merkle_witnesses"](spark, str(tmp_path)).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{"en": 1}, {"en": 8, None: 1}, {"en": 9, "de": 513, "": 64}, {"en": 1030, "é": 2, "z": 512}])
def test_against_levels(spark, tmp_path, sizes):
    rows = [(1000 * k + 7 * i, f"s{i % 3}", lang, i, f"Text {i}\nÉ {lang}") for k, (lang, n) in enumerate(sizes.items()) for i in range(n)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_many_trees(spark, tmp_path):
    """More trees than one block of roots holds."""
    rows = [(i, "s", f"l{i % 600}", i, f"T{i}") for i in range(700)]
    assert found(spark, tmp_path, rows) == expected(rows)


def test_hard_rows(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows and keys."""
    rows = [(i, source, lang, n, text) for i, text, lang, source, n in edge_rows()]
    assert found(spark, tmp_path, rows) == expected(rows)
    assert found(spark, tmp_path, []) == []


def test_clashing_names_and_repeated_rows(spark):
    rows = spark.range(20).selectExpr("1 AS _tree", "2 AS _place", "id div 10 AS digest", "'x' AS row", "id % 5 AS root")
    got = merkle.manifest(rows, F.col("root"), F.sha2(F.col("row"), 256), [F.col("digest")])
    assert got.count() == 20 and got.select("row.*").columns == rows.columns
    assert got.filter(merkle.folded(F.col("digest"), F.col("witness")) != F.col("root")).count() == 0


def test_appended_one_by_one():
    """The frontier holds open subtrees only, and closing follows the same levels for every number."""
    for n in [1, 2, 7, 8, 9, 63, 64, 65, 511, 512]:
        nodes = [H(str(i)) for i in range(n)]
        appender = merkle.Appender()
        for node in nodes:
            appender.append(node)
            assert all(len(level) < merkle.FAN for level in appender.open)
        root, paths = reduced(nodes)
        assert appender.close(None) == root and appender.witnesses == paths
