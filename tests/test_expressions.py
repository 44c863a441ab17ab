"""Row-level expressions, staging and joins on hand-written rows."""

import math

import pytest
from pyspark.sql import functions as F

from riskweave import fixtures, schema as S
from riskweave.functions import scalars as X
from riskweave.operators import joins
from riskweave.operators.evaluate import with_tiers
from riskweave.plans import features, staging


def one(spark, expr, **values):
    cols = [F.lit(v).alias(k) if v is not None else F.lit(None).cast("string").alias(k) for k, v in values.items()]
    return spark.range(1).select(*cols).select(expr).first()[0]


@pytest.mark.parametrize("dt,hour,dow,day", [(86400, 0, 1, 1), (691199, 23, 0, 7)])
def test_time_parts(spark, dt, hour, dow, day):
    c = F.lit(dt).cast("bigint")
    assert spark.range(1).select(X.hour_of(c), X.dow_of(c), X.day_of(c)).first()[:] == (hour, dow, day)


def test_amount_forms(spark):
    assert one(spark, X.amt_decimal(F.col("a")), a=100.25) == 0.25
    assert one(spark, X.log_amt(F.col("a")), a=100.25) == pytest.approx(math.log(101.25), rel=1e-15)


@pytest.mark.parametrize("text,width,height", [
    ("1920x1080", 1920, 1080), ("800x", 800, -999), ("bad", -999, -999), (None, -999, -999), ("1.5x2.4", 2, 2)])
def test_screen(spark, text, width, height):
    assert one(spark, X.screen_part(F.col("t"), 1), t=text) == width
    assert one(spark, X.screen_part(F.col("t"), 2), t=text) == height


@pytest.mark.parametrize("text,status", [("match_status:-1", -1), ("match_status:2", 2), ("junk", -999), (None, -999)])
def test_match_status(spark, text, status):
    assert one(spark, X.match_status(F.col("t")), t=text) == status


@pytest.mark.parametrize("score,tier", [
    (0.0, None), (0.3, "LOW"), (0.30001, "MEDIUM"), (0.6, "MEDIUM"), (0.8, "HIGH"), (1.0, "CRITICAL"), (1.1, None)])
def test_risk_tier(spark, score, tier):
    assert with_tiers(spark.range(1).select(F.lit(score).alias("score"))).first()["risk_tier"] == tier


@pytest.mark.parametrize("num,den,pct", [(1, 3, 33.33), (1, 8, 12.5), (1, 800, 0.13), (0, 5, 0.0), (1, 0, None)])
def test_pct_is_half_up(spark, num, den, pct):
    assert one(spark, X.pct2(F.col("n").cast("bigint"), F.col("d").cast("bigint")), n=num, d=den) == pct


def test_uid_needs_both_parts(spark):
    assert one(spark, X.uid(F.lit(7), F.col("a")), a=315.0) == "7_315.0"
    assert one(spark, X.uid(F.lit(None).cast("bigint"), F.col("a")), a=315.0) is None


def test_flags(spark):
    assert [one(spark, X.flag(F.col("t")), t=t) for t in ("T", "F", None)] == [1, 0, 0]
    assert [one(spark, X.bool_flag(F.col("t")), t=t) for t in ("T", "F", None)] == [1, 0, 0]
    assert one(spark, X.amount_ratio(F.lit(5.0), F.col("a")), a=0.0) is None


def test_v_columns_are_discovered(spark):
    df = spark.sql("SELECT 1.0D AS V2, CAST(NULL AS DOUBLE) AS V10, 'x' AS VX, 1 AS Value, 2 AS V")
    assert S.v_columns(df) == ["V2", "V10"]
    assert df.select(*staging.coalesce_v(df)).first()[:] == (1.0, -999.0)


def test_projection_helpers(spark):
    df = spark.range(1).withColumn("x", F.lit(2))
    assert staging.rename_passthrough(df, {"x": "y"}).columns == ["y"]
    assert staging.append(df, z=F.col("x") + 1).first()[:] == (0, 2, 3)


def test_transaction_without_identity(spark, sf_dir):
    t = staging.stg_transaction(fixtures.raw_transaction(spark, sf_dir))
    i = staging.stg_identity(fixtures.raw_identity(spark, sf_dir))
    joined = features.int_joined(t, i)
    assert joined.count() == t.count()
    row = joined.filter(f"{S.KEY} = 1").first()
    assert (row["has_identity"], row["no_browser_os_signal"], row["id_01"], row["device_type"]) == (0, 0, -999.0, "unknown")
    assert joined.filter("has_identity = 1").count() == i.count()
    assert joined.filter(" OR ".join(f"{c} IS NULL" for c in S.IDENTITY_DEFAULTS)).count() == 0


def test_null_safe_attach(spark):
    left = spark.sql("SELECT * FROM VALUES (1, 'a'), (2, NULL) AS t(x, k)")
    right = spark.sql("SELECT * FROM VALUES ('a', 10), (NULL, 20) AS t(k, v)")
    rows = joins.attach(left, right, ["k"]).orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(1, "a", 10), (2, None, 20)]


def test_feature_roles_add_up():
    assert len(S.FEATURE_COLUMNS) == len(set(S.FEATURE_COLUMNS)) == 118
    assert (len(S.CATEGORICAL), len(S.NUMERIC), len(S.IDENTITY_DEFAULTS), len(S.REQUIRED)) == (20, 90, 47, 17)
    assert set(S.CATEGORICAL + S.NUMERIC) < set(S.FEATURE_COLUMNS)
