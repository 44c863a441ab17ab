"""Rolling aggregates over calendar-day ranges.

A frame of ``days`` reaches from ``day - days`` to ``day``: that is ``days + 1`` day buckets, and
it includes the row itself and everything else of its day.  ``strict=True`` leaves the own day out.

All rows of one key and day share one answer.  The ``daily`` strategy therefore sums up each
(key, day) first -- mostly map-side -- and slides the frame over at most one row per day.  A key
that holds a third of all rows is then a few hundred rows, not one giant window partition.  The
answers go back to the rows by an equi-join whose small side has one row per (key, day), which
the optimizer may broadcast when it proves small and which adaptive execution splits when one
(key, day) is oversized.  The ``window`` strategy is the plain frame over all rows, of which the
window holds no more than key, day and amount.

Keys and days are matched null-safe: rows without a key form a group of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import scalars as X
from .joins import attach

N, TOTAL, FILLED = "_n", "_total", "_filled"


def day_frame(key: str, day: str, days: int, strict: bool = False) -> WindowSpec:
    return W.partitionBy(key).orderBy(day).rangeBetween(-days, -1 if strict else 0)


def daily_totals(df: DataFrame, keys: list[str], amount: str | None = S.AMOUNT) -> DataFrame:
    """Rows, exact amount total and number of filled amounts per key set."""
    aggs = [F.count(F.lit(1)).alias(N)]
    if amount:
        aggs += [F.sum(F.col(amount).cast(S.MONEY)).alias(TOTAL), F.count(amount).alias(FILLED)]
    return df.groupBy(*keys).agg(*aggs)


def framed(kind: str, frame: WindowSpec) -> Column:
    """Aggregate ``kind`` over a frame of daily totals."""
    if kind == "count":
        return F.coalesce(F.sum(N).over(frame), F.lit(0).cast("bigint"))
    if kind == "sum":
        return F.sum(TOTAL).over(frame).cast("double")
    if kind == "avg":
        filled = F.nullif(F.sum(FILLED).over(frame), F.lit(0).cast("bigint"))
        return F.sum(TOTAL).over(frame).cast("double") / filled
    raise ValueError(f"unknown rolling aggregate {kind!r}")


def _framed_rows(kind: str, frame: WindowSpec, amount: str) -> Column:
    if kind == "count":
        return F.count(F.lit(1)).over(frame)
    total = F.sum(F.col(amount).cast(S.MONEY)).over(frame).cast("double")
    if kind == "sum":
        return total
    if kind == "avg":
        return total / F.nullif(F.count(amount).over(frame), F.lit(0).cast("bigint"))
    raise ValueError(f"unknown rolling aggregate {kind!r}")


def daily_lookup(df: DataFrame, key: str, frames: dict[str, tuple[str, int]], day: str = S.DAY,
                 amount: str = S.AMOUNT, strict: bool = False) -> DataFrame:
    """One row per (key, day) with every ``{name: (aggregate, days)}`` of ``frames``."""
    needs_amount = any(kind != "count" for kind, _ in frames.values())
    totals = daily_totals(df, [key, day], amount if needs_amount else None)
    return totals.select(
        key, day,
        *[framed(kind, day_frame(key, day, days, strict)).alias(n) for n, (kind, days) in frames.items()],
    )


def direct_lookup(df: DataFrame, key: str, frames: dict[str, tuple[str, int]], day: str = S.DAY,
                  amount: str = S.AMOUNT, strict: bool = False) -> DataFrame:
    """:func:`daily_lookup` by plain frames over all rows.

    A window keeps all rows of its key, so it is given the columns it needs and nothing else."""
    needs_amount = any(kind != "count" for kind, _ in frames.values())
    rows = df.select(key, day, *([amount] if needs_amount else []))
    answers = [_framed_rows(kind, day_frame(key, day, days, strict), amount).alias(n) for n, (kind, days) in frames.items()]
    return rows.select(key, day, *answers).distinct()


LOOKUPS = {"daily": daily_lookup, "window": direct_lookup}


def rolling(
    df: DataFrame,
    key: str,
    days: int,
    aggs: dict[str, str],
    day: str = S.DAY,
    amount: str = S.AMOUNT,
    strategy: str = "daily",
    strict: bool = False,
) -> DataFrame:
    """``df`` plus one column per ``aggs`` entry ``{name: count | sum | avg}`` over the frame."""
    if strategy not in LOOKUPS:
        raise ValueError(f"unknown rolling strategy {strategy!r}")
    frames = {n: (kind, days) for n, kind in aggs.items()}
    return attach(df, LOOKUPS[strategy](df, key, frames, day, amount, strict), [key, day])


#: Velocity columns by key: ``{column: (aggregate, days)}``.
VELOCITY_FRAMES = {
    "card1": {
        "card1_txn_count_7d": ("count", 7),
        "card1_amt_sum_7d": ("sum", 7),
        "card1_avg_amt_30d": ("avg", 30),
    },
    "uid": {"uid_txn_count_30d": ("count", 30)},
    "p_email_clean": {"email_txn_count_7d": ("count", 7)},
}


def velocity(
    df: DataFrame,
    strategy: str = "daily",
    strict: bool = False,
    source: DataFrame | None = None,
) -> DataFrame:
    """Card, e-mail and customer velocity over 7 and 30 days.

    Every distinct (card, customer, e-mail, day) is answered on a narrow table first and then joined
    to the wide rows, which are shuffled once instead of once per key.

    ``source`` may name a cheaper table with the same transactions, such as the staged
    transactions before they were joined: totals then come from a scan of five columns.  The
    ``window`` strategy reads ``df`` itself.
    """
    def with_uid(t: DataFrame) -> DataFrame:
        return t.withColumn("uid", X.uid(F.col("card1"), F.col("addr1_clean")))

    out = with_uid(df)
    if strategy not in LOOKUPS:
        raise ValueError(f"unknown rolling strategy {strategy!r}")
    narrow = out if source is None or strategy == "window" else with_uid(source)
    profile = [*VELOCITY_FRAMES, S.DAY]
    answers = narrow.select(*profile).distinct()
    for key, frames in VELOCITY_FRAMES.items():
        answers = attach(answers, LOOKUPS[strategy](narrow, key, frames, strict=strict), [key, S.DAY])
    out = attach(out, answers, profile)
    ratio = X.amount_ratio(F.col(S.AMOUNT), F.col("card1_avg_amt_30d"))
    return out.withColumn("amt_to_card_avg_ratio", ratio)
