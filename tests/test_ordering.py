"""Running totals, medians, rank selection, the time split and seeded samples."""

import random
import statistics

import pytest
from pyspark.sql import functions as F

from riskweave import schema as S
from riskweave.operators import running
from riskweave.operators.running import exact_median, running_totals
from riskweave.operators.selection import kth_smallest, seeded_sample, split_point, time_split


@pytest.fixture(scope="module")
def values(spark):
    rnd = random.Random(3)
    # one value holds a third of the rows
    data = [(rnd.choice("ab"), 0.25 if rnd.random() < 1 / 3 else rnd.randrange(500) / 1000) for _ in range(4000)]
    return data, spark.createDataFrame(data, "g string, v double").cache()


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("fan", [2, 256])
def test_totals_by_brute_force(values, descending, fan, monkeypatch):
    """Parts in one window, and in three levels of windows over two each."""
    monkeypatch.setattr(running, "FAN", fan)
    data, df = values
    found = running_totals(df, "v", {"n": F.count(F.lit(1))}, by=("g",), descending=descending).collect()
    assert len(found) == len(set(data))
    for row in found:
        reached = [x for g, x in data if g == row["g"] and (x >= row["v"] if descending else x <= row["v"])]
        assert row["cum_n"] == len(reached)
        assert row["total_n"] == sum(g == row["g"] for g, _ in data)


def test_no_window_without_a_key(values):
    _, df = values
    plan = running_totals(df, "v", {"n": F.count(F.lit(1))})._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "SinglePartition" not in plan


def test_ranks(spark):
    data = [(g, f"{g}{i:03}") for g in "abc" for i in range(50 * (g == "a") + 3)] + [(None, "x")]
    df = spark.createDataFrame(data, "g string, v string").repartition(5)
    found = {(r["g"], r["v"]): r["code"] for r in running.numbered(df, ("g",), "v", "code").collect()}
    assert found == {(g, v): sorted(x for h, x in data if h == g).index(v) for g, v in data}


def test_exact_median(values):
    data, df = values
    got = {r["g"]: r["median"] for r in exact_median(df, "v", by=("g",)).collect()}
    assert got == {g: pytest.approx(statistics.median(x for h, x in data if h == g)) for g in "ab"}


def test_kth_smallest(spark):
    rnd = random.Random(5)
    data = [rnd.randrange(-10**12, 10**12) for _ in range(500)] + [17] * 250
    df = spark.createDataFrame([(x,) for x in data], "x long")
    for k in (1, 2, 300, 374, 400, 749, 750):
        value = sorted(data)[k - 1]
        assert kth_smallest(df, "x", k) == (value, sum(x < value for x in data))


def test_time_split_is_exact(spark):
    rnd = random.Random(11)
    # nearly everything happens on one day
    rows = [(i * 7919 % 100003, 5 if rnd.random() < 0.9 else rnd.randrange(10)) for i in range(1003)]
    df = spark.createDataFrame(rows, f"{S.KEY} long, {S.DAY} long")
    train, rest = time_split(df, 0.8)
    ordered = sorted(rows, key=lambda r: (r[1], r[0]))
    assert sorted(map(tuple, train.collect())) == sorted(ordered[:802])
    assert train.count() + rest.count() == 1003
    assert split_point(df.limit(1), 0.5).day is None


def test_sample_does_not_depend_on_partitioning(spark):
    df = spark.range(1000).withColumnRenamed("id", S.KEY)
    a = {r[0] for r in seeded_sample(df.repartition(7), 50).collect()}
    assert a == {r[0] for r in seeded_sample(df.coalesce(1), 50).collect()} and len(a) == 50
    assert a != {r[0] for r in seeded_sample(df, 50, seed=1).collect()}
