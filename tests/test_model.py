"""Training, scoring and explanations on the test tables."""

import itertools
import math
import time
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskweave import registry
from riskweave import schema as S
from riskweave.plans import explain, model
from riskweave.plans.ensemble import NODE, Ensemble
from riskweave.session import cut_lineage, scratch_path

EXPECTED = [
    S.KEY, "fraud_score", "fraud_predicted", "risk_tier", S.LABEL, "model_used", "is_exotic_browser",
    "no_browser_os_signal", "device_type", "browser_family", "os_version_group", "device_manufacturer",
    "p_email_group", "txn_hour", "txn_time_bucket", "card1_txn_count_7d", "amt_to_card_avg_ratio"]


@pytest.fixture(scope="module")
def ready(spark, sf_dir):
    """Both candidates with short training runs; test_configured_models.py holds the registered ones."""
    feat = cut_lineage(registry.QUERIES["feat_final"](spark, sf_dir))
    prepared = model.prepare(feat)
    model.train_candidates(
        prepared, replace(model.BOOSTING, rounds=20, depth=5), replace(model.LEAFWISE, rounds=20, leaves=9)
    )
    known, registry._trained = registry._trained, {(spark.sparkContext.applicationId, sf_dir): prepared}
    yield prepared
    registry._trained = known


def test_split_and_comparison(spark, sf_dir, ready):
    n = ready.train.count() + ready.validation.count()
    assert ready.train.count() == int(n * 0.8)
    table = registry.model_comparison(spark, sf_dir).orderBy("position").collect()
    assert [r["model"] for r in table] == [model.BOOSTED, model.LEAF_WISE]
    assert all(0.5 < r["roc_auc"] <= 1 and 0 < r["pr_auc"] <= 1 for r in table)
    best = registry.best_model(spark, sf_dir).first()
    assert best["roc_auc"] == max(r["roc_auc"] for r in table)


def test_predictions(spark, sf_dir, ready):
    table = registry.predictions(spark, sf_dir)
    assert table.columns == EXPECTED
    assert table.count() == ready.validation.count()
    assert table.filter("fraud_predicted <> CAST(fraud_score >= 0.5 AS INT)").count() == 0


def test_importance_and_drill_through(spark, sf_dir, ready):
    top = registry.feature_importance_top20(spark, sf_dir).collect()
    assert len(top) == 20 and top[0]["importance"] >= top[-1]["importance"]
    assert len(ready.features) == 110
    drivers = registry.drill_through(spark, sf_dir).collect()
    sizes = [abs(r["contribution"]) for r in drivers]
    assert sizes == sorted(sizes, reverse=True) and len({r[S.KEY] for r in drivers}) == 1


@pytest.mark.parametrize("name", [model.BOOSTED, model.LEAF_WISE])
def test_contributions_add_up_to_the_score(ready, name):
    fitted = ready.fitted[name]
    scored = model.score(fitted, ready.validation).select(S.KEY, F.log(F.col("score") / (1 - F.col("score"))).alias("margin"))
    total = F.col("base") + F.aggregate("contributions", F.lit(0.0), lambda a, b: a + b)
    worst = explain.attribute(ready.validation, fitted.trees).join(scored, S.KEY).agg(
        F.max(F.abs(total - F.col("margin"))), F.count(F.lit(1))).first()
    assert worst[0] < 1e-8 and worst[1] == ready.validation.count()


def random_tree(rng, depth, n_features):
    tree = np.zeros(1, dtype=NODE)
    tree["feature"], tree["n"] = -1, 1000
    open_nodes = [(0, depth)]
    while open_nodes:
        node, left = open_nodes.pop(0)
        if not left or tree["n"][node] < 2 or rng.random() < 0.15 and node:
            tree["value"][node] = rng.normal()
            continue
        tree["feature"][node], tree["threshold"][node] = rng.integers(n_features), round(rng.normal(), 1)
        tree["left"][node], tree["right"][node] = len(tree), len(tree) + 1
        pair = np.zeros(2, dtype=NODE)
        pair["feature"] = -1
        pair["n"][0] = rng.integers(1, tree["n"][node])
        pair["n"][1] = tree["n"][node] - pair["n"][0]
        open_nodes += [(len(tree), left - 1), (len(tree) + 1, left - 1)]
        tree = np.concatenate([tree, pair])
    return tree


@pytest.mark.parametrize("depth", [0, 1, 3, 8])
def test_shapley_values_by_definition(depth):
    """Every subset of five features, each expectation by walking the tree."""
    rng, n = np.random.default_rng(depth), 5
    trees = [random_tree(rng, depth, n) for _ in range(3)]
    x = rng.normal(size=(4, n)).round(1)

    def expectation(tree, row, known, node=0):
        if tree["feature"][node] < 0:
            return tree["value"][node]
        f, pair = tree["feature"][node], (tree["left"][node], tree["right"][node])
        if f in known:
            return expectation(tree, row, known, pair[int(row[f] > tree["threshold"][node])])
        return sum(tree["n"][c] / tree["n"][node] * expectation(tree, row, known, c) for c in pair)

    got = explain.shapley_values(x, [explain.tree_leaves(t) for t in trees])
    for row, values in zip(x, got):
        for j in range(n):
            others, value = [k for k in range(n) if k != j], 0.0
            for size in range(n):
                for known in itertools.combinations(others, size):
                    share = math.factorial(size) * math.factorial(n - 1 - size) / math.factorial(n)
                    value += share * sum(expectation(t, row, {*known, j}) - expectation(t, row, set(known)) for t in trees)
            assert values[j] == pytest.approx(value, abs=1e-10)
    base = sum(explain.tree_leaves(t).base for t in trees)
    assert base + got.sum(axis=1) == pytest.approx(Ensemble([], 0.0, trees).margins(x))


def test_explaining_many_deep_trees_is_quick():
    """200 trees of depth 8: linear in trees, leaves and depth."""
    rng = np.random.default_rng(5)
    trees = [explain.tree_leaves(random_tree(rng, 8, 40)) for _ in range(200)]
    start = time.perf_counter()
    explain.shapley_values(rng.normal(size=(100, 40)), trees)
    assert time.perf_counter() - start < 30


def test_rows_look_up_what_their_leaves_contribute(monkeypatch):
    """Each way the bounds of a leaf can hold is worked out once, not once a row."""
    rng, worked = np.random.default_rng(6), []
    trees = [explain.tree_leaves(random_tree(rng, depth, 9)) for depth in (0, 2, 5)]
    x = rng.normal(size=(700, 9)).round(1)
    by_row = np.concatenate([explain.shapley_values(row[None], trees) for row in x])
    own = explain._leaf_parts
    monkeypatch.setattr(explain, "_leaf_parts", lambda leaves, met: worked.append(met.size) or own(leaves, met))
    assert explain.shapley_values(x, trees) == pytest.approx(by_row, abs=1e-12)
    assert sum(worked) == sum(t.feature.size << t.feature.shape[1] for t in trees)


def test_encoding_and_storage(spark, ready):
    df = spark.createDataFrame([("b", "x"), ("a", None), ("c", "y"), ("a", "x")], "k string, l string").repartition(3)
    encoded, codes = model.label_encode(df, ["k", "l"])
    assert encoded.columns == ["k", "l", "k_code", "l_code"]
    assert {(r["k"], r["k_code"]) for r in encoded.collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert {(r["l"], r["l_code"]) for r in encoded.collect()} == {("x", 0), ("y", 1), (None, 2)}
    assert model.encode(spark.sql("SELECT 'zz' AS k"), codes, ["k"]).first()["k_code"] == 3
    path = scratch_path(spark, "model")
    fitted = ready.fitted[model.BOOSTED]
    fitted.save(path)
    again = model.Fitted.load(spark, path)
    assert again.name == model.BOOSTED and again.trees.features == ready.features
    feat = cut_lineage(ready.validation.drop("x"))
    scores = lambda m, df: sorted(r["score"] for r in model.score(m, df).collect())
    assert scores(again, again.inputs(feat)) == scores(fitted, ready.validation)


def test_weights(spark):
    train = spark.createDataFrame([(0,)] * 3 + [(1,)], f"{S.LABEL} int")
    weights = train.select(S.LABEL, model.pos_weight(train).alias("p"), model.balanced_weight(train).alias("b"))
    assert {tuple(r) for r in weights.distinct().collect()} == {(0, 1.0, 4 / 6), (1, 3.0, 2.0)}
    filled = model.sentinel_fill(spark.sql("SELECT CAST(NULL AS INT) AS a, CAST(NULL AS STRING) AS b, '-999' AS c")).first()
    assert tuple(filled) == (-999, "unknown", "unknown")


def test_short_dictionaries_are_looked_up_without_a_join(spark, monkeypatch):
    df = spark.sql("SELECT * FROM VALUES ('b', 'y', 1), ('a', 'x', 2), (NULL, NULL, 3), ('b', 'z', 4), ('c', 'x', 5) AS t(k, l, n)")
    codes = model.dictionary(df.filter("n < 5"), ["k", "l"])
    found = model.encode(df, codes, ["k", "l"])
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    rows = [("b", "y", 1, 1, 1), ("a", "x", 2, 0, 0), (None, None, 3, 2, 3), ("b", "z", 4, 1, 2), ("c", "x", 5, 2, 0)]
    for listed in (64, 2, 0):  # all listed, one listed and one joined, all joined
        monkeypatch.setattr(model, "LISTED", listed)
        again = model.encode(df, codes, ["k", "l"])
        assert again.columns == ["k", "l", "n", "k_code", "l_code"] and again.dtypes == found.dtypes
        assert sorted(map(tuple, again.collect()), key=lambda r: r[2]) == rows
