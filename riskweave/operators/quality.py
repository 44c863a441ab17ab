"""Data-quality checks: each returns the offending rows, an empty result is a pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scalars import pct2
from ..session import cut_lineage


def not_null_violations(df: DataFrame, columns: list[str] = S.REQUIRED) -> DataFrame:
    """Rows with a NULL in any of ``columns``."""
    return df.filter(reduce(Column.__or__, [F.col(c).isNull() for c in columns]))


def duplicate_keys(df: DataFrame, key: str = S.KEY) -> DataFrame:
    """Keys that occur more than once and how often."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def amount_violations(df: DataFrame, amount: str = S.AMOUNT) -> DataFrame:
    """Rows whose amount the log transform cannot take."""
    return df.filter(F.col(amount) <= -1)


def assert_no_rows(df: DataFrame, check: str = "check") -> None:
    """Raise with a few examples when ``df`` has rows."""
    examples = df.take(5)
    if examples:
        raise AssertionError(f"{check}: offending rows, for example {examples}")


def assert_count(df: DataFrame, expected: int) -> None:
    """Raise when the number of rows differs."""
    found = df.count()
    if found != expected:
        raise AssertionError(f"expected {expected} rows, found {found}")


def class_share(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Share of the positive class, one row."""
    counts = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(label) == 1).alias("positives"))
    return counts.withColumn("positive_pct", pct2(F.col("positives"), F.col("n")))


def assert_class_share(df: DataFrame, low_pct: float, high_pct: float, label: str = S.LABEL) -> None:
    """Raise when the positive class falls outside the given percentages."""
    share = class_share(df, label).first()["positive_pct"]
    if share is None or not low_pct <= share <= high_pct:
        raise AssertionError(f"positive class is {share} %, expected {low_pct} to {high_pct} %")


def watch(df: DataFrame, columns: list[str] = S.REQUIRED) -> tuple[DataFrame, Observation]:
    """``df`` and what its checks find in the rows of the first job that runs over it, a write for
    instance, without a scan of their own: offending rows by check."""
    found = Observation()
    checks = [F.count_if(F.col(c).isNull()).alias(f"not_null:{c}") for c in columns]
    checks.append(F.count_if(F.col(S.AMOUNT) <= -1).alias("log_domain:" + S.AMOUNT))
    return df.observe(found, *checks), found


def assert_watched(found: Observation) -> None:
    """Raise when a watched check found offending rows."""
    bad = {check: n for check, n in found.get.items() if n}
    if bad:
        raise AssertionError(f"offending rows by check: {bad}")


def quality_report(df: DataFrame, columns: list[str] = S.REQUIRED, key: str = S.KEY) -> DataFrame:
    """One row per check with the number of offending rows.

    All are counted while the rows are written once, but for unique keys, which need the keys of
    all rows together and read that column of the written copy.
    """
    watched, found = watch(df, columns)
    unique = duplicate_keys(cut_lineage(watched).select(key), key).agg(
        F.lit(f"unique:{key}").alias("check"), F.count(F.lit(1)).alias("violations")
    )
    # bounded: one row per check
    counts = ", ".join(f"('{check}', {n}L)" for check, n in found.get.items())
    rows = df.sparkSession.sql(f"SELECT * FROM VALUES {counts} AS checks(check, violations)")
    return rows.unionByName(unique).withColumn("passed", F.col("violations") == 0)
