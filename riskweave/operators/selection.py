"""Exact rank selection and the time-ordered split built on it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

BINS = 4096


def kth_smallest(df: DataFrame, column: str, k: int) -> tuple[int, int]:
    """The ``k``-th smallest (1-based) whole number in ``column`` and how many rows lie below it.

    Narrows the range of candidates by histograms of at most BINS rows until one value is left:
    a few aggregations over one column, however large or skewed, and no sort.
    """
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    below = 0
    while lo < hi:
        width = -(-(hi - lo + 1) // BINS)
        value = F.col(column)
        # bounded: at most BINS rows reach the driver
        bins = (
            df.filter(value.between(lo, hi))
            .groupBy(F.call_function("div", value - F.lit(lo), F.lit(width)).alias("bin"))
            .count().orderBy("bin").collect()
        )
        for bin_, count in bins:
            if below + count >= k:
                break
            below += count
        lo, hi = lo + bin_ * width, min(hi, lo + (bin_ + 1) * width - 1)
    return lo, below


@dataclass(frozen=True)
class SplitPoint:
    """Last position of the training part; ``None`` when that part is empty."""

    day: int | None
    tie: int | None
    day_column: str = S.DAY
    tie_column: str = S.KEY

    def is_train(self) -> Column:
        if self.day is None:
            return F.lit(False)
        day, tie = F.col(self.day_column), F.col(self.tie_column)
        within = (day < self.day) | ((day == self.day) & (tie <= self.tie))
        return F.coalesce(within, F.lit(False))


def split_point(df: DataFrame, fraction: float = 0.8, day: str = S.DAY, tie: str = S.KEY) -> SplitPoint:
    """Where the first ``fraction`` of the rows ends, by day and then by ``tie``.

    The split is a plain predicate afterwards: no sort, no window, no shuffle of the wide rows.
    ``tie`` is expected to be unique; copies of the boundary row stay together in training.
    """
    narrow = df.select(day, tie)
    k = int(narrow.count() * fraction)
    if k == 0:
        return SplitPoint(None, None, day, tie)
    last_day, below = kth_smallest(narrow, day, k)
    last_tie, _ = kth_smallest(narrow.filter(F.col(day) == last_day), tie, k - below)
    return SplitPoint(last_day, last_tie, day, tie)


def time_split(
    df: DataFrame, fraction: float = 0.8, day: str = S.DAY, tie: str = S.KEY
) -> tuple[DataFrame, DataFrame]:
    """(train, validation): the first ``fraction`` of the rows in time order, and the rest."""
    is_train = split_point(df, fraction, day, tie).is_train()
    return df.filter(is_train), df.filter(~is_train)


def seeded_sample(df: DataFrame, n: int, seed: int = 42, key: str = S.KEY) -> DataFrame:
    """``n`` rows, the same ones on every run and for every partitioning.

    The sample is the ``n`` rows with the smallest digest of key and seed: a top-k, in which every
    task hands on its own ``n`` best rows at most.
    """
    digest = F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))
    return df.orderBy(digest, key).limit(n)
