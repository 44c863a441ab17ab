"""Text ladders: every arm, and the traps in their order."""

import pytest
from pyspark.sql import functions as F

from riskweave.functions import rulebook as R
from riskweave.functions import scalars as X
from riskweave.functions.ladders import Except, Ladder, Names, ilike_any, like_any, not_ilike

LADDERS = {n: v for n, v in vars(R).items() if isinstance(v, Ladder)}


def classify(spark, ladder, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r[0] for r in df.select("i", ladder.column("t").alias("g")).orderBy("i").select("g").collect()]


def example(test):
    if isinstance(test, Names):
        return test.values[0]
    pattern = test.pattern if isinstance(test, Except) else test
    return pattern.strip("%").replace("%", " x ").replace("_", ".")


@pytest.mark.parametrize("name", sorted(LADDERS))
def test_first_matching_arm_wins(spark, name):
    """An example of each pattern lands in its arm unless an earlier arm also holds for it."""
    import fnmatch

    ladder = LADDERS[name]

    def holds(test, text):
        fold = (lambda s: s) if ladder.case_sensitive else str.lower
        if isinstance(test, Names):
            return text in test.values
        if isinstance(test, Except):
            return holds(test.pattern, text) and not holds(test.unless, text)
        return fnmatch.fnmatchcase(fold(text), fold(test).replace("%", "*").replace("_", "?"))

    texts = [example(t) for _, tests in ladder.arms for t in tests] + [None, "zzz"]
    expected = [
        ladder.if_null if text is None
        else next((lab for lab, tests in ladder.arms if any(holds(t, text) for t in tests)), ladder.otherwise)
        for text in texts
    ]
    assert classify(spark, ladder, texts) == expected
    assert set(expected) <= set(ladder.labels())


def test_browser_order(spark):
    """``%ie%`` comes before the web views and matches the text "webview" itself."""
    texts = ["mobile safari uiwebview", "Palemoon", "palemoon", "chrome 62.0 for ios", "android webview 4.0",
             "chrome safari", "movie player", "SILK"]
    assert classify(spark, R.STG_BROWSER_FAMILY, texts) == [
        "safari", "other", "exotic", "chrome_mobile", "ie", "chrome", "ie", "silk"]
    assert classify(spark, R.EDA_BROWSER_FAMILY, ["chrome safari"]) == ["Safari"]


def test_email_case_matters(spark):
    assert classify(spark, R.EMAIL_GROUP, ["gmail.com", "Gmail.com", "yahoo.com.mx", None]) == [
        "gmail", "other", "yahoo", "unknown"]


def test_ladders_differ_on_purpose(spark):
    devices = ["ONEPLUS A3003", "F3113 Build/33", "SAMSUNG SM-G531H", "iOS Device"]
    assert classify(spark, R.EDA_MANUFACTURER, devices) == ["OnePlus", "Sony", "Samsung", "Apple (iOS)"]
    assert classify(spark, R.STG_MANUFACTURER, devices) == ["other", "other", "samsung", "other"]
    assert classify(spark, R.EDA_SAMSUNG_TIER, devices[2:3]) == ["Samsung Budget (G3/G5xx)"]
    assert classify(spark, R.STG_SAMSUNG_TIER, devices[2:3]) == [None]


def test_chrome_buckets(spark):
    texts = ["chrome 49.0", "Chrome 57.0", "chrome 64.0", "chrome 65", "chrome generic", "firefox 57.0", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    low = F.lower("t")
    got = df.select("i", X.chrome_bucket(low, X.chrome_major(low), R.STG_CHROME_BUCKETS).alias("b"))
    assert [r["b"] for r in got.orderBy("i").collect()] == [
        "chrome_old", "chrome_55_59", "chrome_60_64", "chrome_65_plus", "chrome_unknown", None, None]


def test_wildcard_helpers(spark):
    row = spark.sql("SELECT 'Gmail.com' AS t, CAST(NULL AS STRING) AS n").select(
        ilike_any(F.col("t"), "x%", "%GMAIL%"), like_any(F.col("t"), "%gmail%"),
        not_ilike(F.col("t"), "%yahoo%"), not_ilike(F.col("n"), "%a%")).first()
    assert tuple(row) == (True, False, True, None)
