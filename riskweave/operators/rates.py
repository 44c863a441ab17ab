"""Counting operators: class balance, segment fraud rates, distributions, null counts, top-k.

Every grouping is pre-summed map-side, so a group with a third of all rows costs one row per task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.scalars import pct2
from .running import exact_median


def row_count(df: DataFrame, name: str = "n") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def share_of_total(df: DataFrame, n: str, name: str = "percentage") -> DataFrame:
    """Add each row's share of the grand total of ``n``; for results that are already aggregated."""
    return df.withColumn(name, pct2(F.col(n), F.sum(n).over(W.partitionBy())))


def class_balance(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Rows and share per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("transaction_count"))
    return order_by(share_of_total(counts, "transaction_count"), label)


def fraud_rate(
    df: DataFrame,
    keys: list[str] | dict[str, Column],
    label: str = S.LABEL,
    min_total: int | None = None,
) -> DataFrame:
    """Rows, frauds and fraud rate per key set; NULL keys form groups of their own.

    ``min_total`` keeps only groups with more rows than that.
    """
    groups = [c.alias(n) for n, c in keys.items()] if isinstance(keys, dict) else keys
    rates = df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("total"),
        F.sum(F.col(label).cast("bigint")).alias("fraud_count"),
    )
    if min_total is not None:
        rates = having_min(rates, "total", min_total)
    return rates.withColumn("fraud_rate_pct", pct2(F.col("fraud_count"), F.col("total")))


def having_min(df: DataFrame, column: str, n: int) -> DataFrame:
    """Groups with more than ``n`` in ``column``."""
    return df.filter(F.col(column) > n)


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def order_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.orderBy(*keys)


def order_by_rate(df: DataFrame, keys: list[str], rate: str = "fraud_rate_pct") -> DataFrame:
    """Highest rate first, unknown rates before all, ties by key."""
    return df.orderBy(F.desc_nulls_first(rate), *keys)


def top(df: DataFrame, n: int, by: str = "fraud_rate_pct", ties: list[str] = ()) -> DataFrame:
    """The ``n`` rows with the highest ``by``; ``ties`` make the cut repeatable."""
    return df.orderBy(F.desc_nulls_first(by), *ties).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    """Rows of all inputs, matched by column name, copies kept."""
    return reduce(DataFrame.unionByName, dfs)


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing values per column, most first; one pass over the table for all columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = counts.unpivot([], columns, "col", "null_count")
    return rows.orderBy(F.desc("null_count"), "col")


def amount_stats(
    df: DataFrame, by: str = S.LABEL, amount: str = S.AMOUNT, approx: bool = False
) -> DataFrame:
    """Minimum, mean, median, maximum and sample deviation per class, two digits.

    The median is exact and needs no buffer that grows with a class; ``approx`` trades it for a
    sketch that saves a shuffle.
    """
    x = F.col(amount)
    mean = F.sum(x.cast(S.MONEY)).cast("double") / F.nullif(F.count(x), F.lit(0).cast("bigint"))
    aggs = [
        F.round(F.min(x), 2).alias("min_amt"),
        F.round(mean, 2).alias("avg_amt"),
        F.round(F.max(x), 2).alias("max_amt"),
        F.round(F.stddev_samp(x), 2).alias("std_amt"),
    ]
    if approx:
        aggs.append(F.round(F.percentile_approx(x, 0.5, 100_000), 2).alias("median_amt"))
        return df.groupBy(by).agg(*aggs)
    middle = exact_median(df.select(by, x.cast(S.MONEY).alias(amount)), amount, by=(by,))
    rounded = middle.select(
        F.col(by).alias("_by"), F.round("median", 2).cast("double").alias("median_amt")
    )
    stats = df.groupBy(by).agg(*aggs)
    return stats.join(rounded, F.col(by).eqNullSafe(F.col("_by")), "left").drop("_by")


def label_mean(df: DataFrame, by: str | None = None, label: str = S.LABEL) -> DataFrame:
    """Rows, frauds and mean label, overall or per ``by``."""
    groups = [by] if by else []
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col(label).cast("bigint")).alias("fraud_count"),
        F.avg(label).alias("fraud_rate"),
    )


def class_counts(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Legitimate and fraudulent rows and their ratio; NULL ratio without frauds."""
    fraud = F.coalesce(F.sum(F.col(label).cast("bigint")), F.lit(0).cast("bigint"))
    counts = df.agg(F.count(label).alias("n"), fraud.alias("fraud_count"))
    return counts.select(
        (F.col("n") - F.col("fraud_count")).alias("legit_count"),
        "fraud_count",
        F.try_divide(F.col("n") - F.col("fraud_count"), F.col("fraud_count")).alias("scale_pos_weight"),
    )
