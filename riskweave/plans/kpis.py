"""Dashboard measures over the feature table (or any table with the columns named)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions.rulebook import TIME_BUCKETS
from ..functions.scalars import pct2
from ..operators.rates import fraud_rate, order_by_rate


def kpi_overview(df: DataFrame) -> DataFrame:
    """Dollars lost to fraud, transactions processed and base fraud rate."""
    fraud = F.col(S.LABEL) == 1
    sums = df.agg(
        F.coalesce(F.sum(F.when(fraud, F.col(S.AMOUNT).cast(S.MONEY))), F.lit(0)).cast("double").alias("loss_exposure"),
        F.count(F.lit(1)).alias("processed"),
        F.count_if(fraud).alias("fraud_count"),
    )
    return sums.withColumn("base_rate_pct", pct2(F.col("fraud_count"), F.col("processed")))


def kpi_rate(df: DataFrame, key: str) -> DataFrame:
    """Fraud rate per value of ``key``."""
    return order_by_rate(fraud_rate(df, [key]), [key])


def kpi_off_peak(df: DataFrame) -> DataFrame:
    """Share of transactions in the off-peak hours, taken to be the first part of the day."""
    off_peak = F.col("txn_time_bucket") == TIME_BUCKETS[0][2]
    counts = df.agg(F.count_if(off_peak).alias("off_peak"), F.count(F.lit(1)).alias("processed"))
    return counts.withColumn("off_peak_pct", pct2(F.col("off_peak"), F.col("processed")))
