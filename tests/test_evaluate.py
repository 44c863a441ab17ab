"""Evaluation against hand-computed numbers and brute force."""

import random

import pytest

from riskweave import schema as S
from riskweave.operators import evaluate as V


def scored(spark, rows):
    return spark.createDataFrame(rows, f"score double, {S.LABEL} int")


@pytest.fixture(scope="module")
def sample(spark):
    rnd = random.Random(1)
    rows = [(rnd.randrange(40) / 40 + 0.2 * (y := int(rnd.random() < 0.2)), y) for _ in range(600)]
    return rows, scored(spark, rows).cache()


def test_areas_by_brute_force(sample):
    rows, df = sample
    pos, neg = [s for s, y in rows if y], [s for s, y in rows if not y]
    won = sum((p > n) + (p == n) / 2 for p in pos for n in neg)
    assert V.roc_auc(df).first()[0] == pytest.approx(won / len(pos) / len(neg), rel=1e-12)
    precision = 0.0
    for t in sorted(set(pos)):
        tp, fp = sum(s >= t for s in pos), sum(s >= t for s in neg)
        precision += pos.count(t) / len(pos) * tp / (tp + fp)
    assert V.average_precision(df).first()[0] == pytest.approx(precision, rel=1e-12)


def test_constant_score_ranks_nothing(spark):
    assert V.roc_auc(scored(spark, [(0.5, 0), (0.5, 1), (0.5, 0)])).first()[0] == 0.5
    assert V.roc_auc(scored(spark, [(0.5, 0)])).first()[0] is None


def test_pr_curve_ends_at_one_zero(sample):
    rows, df = sample
    points = [tuple(r) for r in V.pr_curve(df).collect()]
    assert (None, 1.0, 0.0) in points
    assert len(points) == len({s for s, _ in rows}) + 1
    lowest = min(p for p in points if p[0] is not None)
    assert lowest[2] == 1.0


def test_threshold_costs_by_hand(spark):
    rows = [(0.9, 1)] * 3 + [(0.9, 0)] * 2 + [(0.1, 1)] + [(0.1, 0)] * 4
    row = V.threshold_costs(scored(spark, rows), [0.5]).first()
    assert (row["precision"], row["recall"], row["fraud_caught_pct"]) == (0.6, 0.75, 75.0)
    assert (row["false_alarm_rate_pct"], row["cost_missed_fraud"], row["cost_false_alarms"], row["total_cost"]) == (
        33.3333, 250, 30, 280)
    conf = V.confusion(scored(spark, rows)).first()
    assert (conf["tp"], conf["fp"], conf["fn"], conf["tn"]) == (3, 2, 1, 4)
    nothing = V.threshold_costs(scored(spark, [(0.1, 0)]), [0.5]).first()
    assert (nothing["precision"], nothing["recall"]) == (0.0, 0.0)


def test_every_threshold_counts_every_row(sample):
    rows, df = sample
    table = V.threshold_costs(df, V.FINE_GRID).orderBy("threshold").collect()
    assert len(table) == 99
    for r in table:
        assert r["true_positives"] == sum(y and s >= r["threshold"] for s, y in rows)
        assert sum(r[c] for c in ("true_positives", "false_positives", "false_negatives", "true_negatives")) == len(rows)
    best = V.best_threshold(V.threshold_costs(df, V.FINE_GRID)).first()
    assert best["total_cost"] == min(r["total_cost"] for r in table)


def test_histogram_integrates_to_one(sample):
    rows, df = sample
    bins = V.score_histogram(df).collect()
    for y in (0, 1):
        own = [s for s, label in rows if label == y]
        width = (max(own) - min(own)) / 50
        assert sum(r["n"] for r in bins if r[S.LABEL] == y) == len(own)
        assert sum(r["density"] * width for r in bins if r[S.LABEL] == y) == pytest.approx(1)
    flat = V.score_histogram(scored(df.sparkSession, [(0.5, 1), (0.5, 1)])).collect()
    assert [r["n"] for r in flat] == [2]


def test_rows_without_a_score_are_no_decision(spark):
    df = spark.createDataFrame([(0.9, 1), (0.1, 0), (None, 1), (float("nan"), 0)], f"score double, {S.LABEL} int")
    one = V.confusion(df).first()
    assert (one["tp"], one["fp"], one["fn"], one["tn"]) == (1, 0, 0, 1)
    for row in V.cross_thresholds(df, [0.05, 0.5, 0.95]).collect():
        assert row["tp"] + row["fp"] + row["fn"] + row["tn"] == 2
    assert V.unscored(df).first()["n_unscored"] == 2
