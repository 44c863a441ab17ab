"""Running totals in value order, without a global sort and without one window over everything.

Rows are first summed up per distinct value (map-side first, so a value held by a third of all
rows is one row).  The distinct values are dealt by ranges into as many parts as a shuffle has,
each part is accumulated by itself, and the totals of the parts before it are added.  Those totals
are found the same way: parts in groups of FAN, groups in groups of FAN, so no window sees more
than FAN of them, however many parts there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import cut_lineage
from .joins import attach

#: Parts whose totals one window accumulates.
FAN = 256
PART = "_part"


def _parts(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def in_ranges(df: DataFrame, keys: list[Column]) -> DataFrame:
    """``df`` dealt by ranges of ``keys``, with its part (from 0) as ``_part``.

    Written once, since dealing anew would cut elsewhere.
    """
    dealt = df.repartitionByRange(_parts(df), *keys)
    return cut_lineage(dealt.withColumn(PART, F.spark_partition_id()))


def totals_before(totals: DataFrame, by: tuple[str, ...], place: str, measures: list[str], places: int) -> DataFrame:
    """``by``, ``place`` and per measure ``_before_<m>``, its sum over lower places, and ``total_<m>``.

    ``totals`` has one row per ``by`` and ``place``, a whole number below ``places``.
    """
    group = "_group_of_" + place
    grouped = totals.withColumn(group, F.floor(F.col(place) / FAN).cast("int"))
    own = W.partitionBy(*by, group)
    earlier = own.orderBy(place).rowsBetween(W.unboundedPreceding, -1)
    inner = {f"_before_{m}": F.coalesce(F.sum(m).over(earlier), F.lit(0)) for m in measures}
    if places <= FAN:
        sums = {f"total_{m}": F.sum(m).over(own) for m in measures}
        return grouped.select(*by, place, *[c.alias(n) for n, c in (inner | sums).items()])
    per_group = grouped.groupBy(*by, group).agg(*[F.sum(m).alias(m) for m in measures])
    outer = totals_before(per_group, by, group, measures, -(-places // FAN))
    outer = outer.withColumnsRenamed({f"_before_{m}": f"_outer_{m}" for m in measures})
    inside = grouped.select(*by, place, group, *[c.alias(n) for n, c in inner.items()])
    both = attach(inside, outer, [*by, group])
    return both.select(
        *by, place,
        *[(F.col(f"_before_{m}") + F.col(f"_outer_{m}")).alias(f"_before_{m}") for m in measures],
        *[f"total_{m}" for m in measures],
    )


def running_totals(
    df: DataFrame,
    value: str,
    measures: dict[str, Column],
    by: tuple[str, ...] = (),
    descending: bool = False,
) -> DataFrame:
    """Per distinct ``value``: each measure, its running total and the total of its group.

    ``measures`` are aggregates that add up (counts, sums).  Columns: ``by``, ``value`` and
    ``<m>``, ``cum_<m>``, ``total_<m>`` per measure.  Rows without a value have no place in the
    order and are left out.
    """
    order = F.desc if descending else F.asc
    present = df.filter(F.col(value).isNotNull())
    per_value = present.groupBy(*by, value).agg(*[m.alias(n) for n, m in measures.items()])
    ranged = in_ranges(per_value, [*[F.col(b).asc() for b in by], order(value)])
    per_part = ranged.groupBy(*by, PART).agg(*[F.sum(n).alias(n) for n in measures])
    offsets = totals_before(per_part, by, PART, list(measures), _parts(df))
    within = W.partitionBy(*by, PART).orderBy(order(value))
    return attach(ranged, offsets, [*by, PART]).select(
        *by, value, *measures,
        *[(F.sum(n).over(within) + F.col(f"_before_{n}")).alias(f"cum_{n}") for n in measures],
        *[f"total_{n}" for n in measures],
    )


def numbered(df: DataFrame, by: tuple[str, ...], value: str, name: str) -> DataFrame:
    """``df`` (one row per ``by`` and ``value``, no null value) with its rank within ``by``, from 0."""
    ranks = running_totals(df, value, {"_rows": F.count(F.lit(1))}, by)
    return ranks.select(*by, value, (F.col("cum__rows") - 1).alias(name))


def exact_median(df: DataFrame, value: str, by: tuple[str, ...] = ()) -> DataFrame:
    """``by`` and the exact ``median`` (mean of the two middle values for even counts)."""
    rows = running_totals(df, value, {"n": F.count(F.lit(1))}, by=by)

    def holds(rank: Column) -> Column:
        return ((rank <= F.col("cum_n")) & (rank > F.col("cum_n") - F.col("n"))).cast("int")

    lower, upper = F.floor((F.col("total_n") + 1) / 2), F.floor(F.col("total_n") / 2) + 1
    middle = rows.withColumn("_weight", holds(lower) + holds(upper)).filter("_weight > 0")
    return middle.groupBy(*by).agg((F.sum(F.col(value) * F.col("_weight")) / 2).alias("median"))
