"""Rolling windows: hand-computed rows and daily against direct frames."""

import random

import pytest

from riskweave import schema as S
from riskweave.operators.rolling import rolling, velocity


def frame(spark, rows):
    return spark.createDataFrame(rows, f"card1 long, {S.DAY} long, {S.AMOUNT} double")


@pytest.mark.parametrize("strategy", ["daily", "window"])
def test_eight_day_buckets(spark, strategy):
    out = rolling(frame(spark, [(1, 1, 5.0), (1, 8, 5.0), (1, 9, 5.0)]), "card1", 7, {"n": "count"}, strategy=strategy)
    assert sorted((r[S.DAY], r["n"]) for r in out.collect()) == [(1, 1), (8, 2), (9, 2)]
    same_day = rolling(frame(spark, [(1, 1, 5.0), (1, 1, 6.0)]), "card1", 7, {"n": "count"}, strategy=strategy)
    assert [r["n"] for r in same_day.collect()] == [2, 2]


@pytest.mark.parametrize("strict", [False, True])
def test_daily_equals_direct_frames(spark, strict):
    """A third of the rows share one key, some keys, days and amounts are missing."""
    rnd = random.Random(7)
    rows = [
        (
            i,
            rnd.choice([0, 0, 0, None, *range(1, 6)]),
            rnd.choice([None, *range(1, 60), *range(1, 60)]),
            rnd.choice([None, *[round(rnd.uniform(0, 99), 2) for _ in range(9)]]),
            rnd.choice(["gmail.com", "unknown", "x.org"]),
            rnd.choice([-999.0, 1.0, 2.0]),
        )
        for i in range(3000)
    ]
    df = spark.createDataFrame(
        rows, f"{S.KEY} long, card1 long, {S.DAY} long, {S.AMOUNT} double, p_email_clean string, addr1_clean double")
    columns = [S.KEY, *S.VELOCITY]
    daily = velocity(df, strict=strict).select(columns).collect()
    direct = velocity(df, strategy="window", strict=strict).select(columns).collect()
    assert len(daily) == len(rows)
    assert sorted(map(repr, daily)) == sorted(map(repr, direct))


def test_unknown_names_are_refused(spark):
    df = frame(spark, [(1, 1, 5.0)])
    with pytest.raises(ValueError):
        rolling(df, "card1", 7, {"n": "count"}, strategy="other")
    with pytest.raises(ValueError):
        rolling(df, "card1", 7, {"n": "mode"})


def test_direct_frames_hold_narrow_rows(spark):
    """What a window keeps does not grow with the other columns of a row."""
    wide = frame(spark, [(1, 1, 5.0), (1, 3, 6.0), (None, 3, None)]).selectExpr("*", *[f"'text {k}' AS c{k}" for k in range(30)])
    out = rolling(wide, "card1", 7, {"n": "count", "total": "sum"}, strategy="window")
    assert sorted((r[S.DAY], r["c7"], r["n"], r["total"]) for r in out.collect() if r["card1"]) == [(1, "text 7", 1, 5.0), (3, "text 7", 2, 11.0)]
    assert [(r["n"], r["total"]) for r in out.collect() if r["card1"] is None] == [(1, None)]
    plan = out._jdf.queryExecution().optimizedPlan()
    windows, stack = [], [plan]
    while stack:
        node = stack.pop()
        stack += [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "Window":
            windows.append(node.children().apply(0).output().size())
    assert windows and max(windows) <= 4  # key, day, amount and its decimal
