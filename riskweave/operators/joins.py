"""Outer joins between transactions and identities, and the defaults that go with them.

Both sides are keyed by the transaction id, which spreads evenly; the physical join (broadcast,
sort-merge, skew split) is left to the optimizer and its runtime sizes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S

HIT = "_identity_hit"


def join_identity(transactions: DataFrame, identities: DataFrame) -> DataFrame:
    """Every transaction with its identity columns, NULL where there is none.

    ``_identity_hit`` is 1 on a match and NULL otherwise.
    """
    return transactions.join(identities.withColumn(HIT, F.lit(1)), S.KEY, "left")


def identity_with_label(identities: DataFrame, transactions: DataFrame) -> DataFrame:
    """Every identity row with the label of its transaction."""
    return identities.join(transactions.select(S.KEY, S.LABEL), S.KEY, "left")


def has_identity(hit: Column) -> Column:
    """1 where an identity row was found."""
    return F.coalesce(hit, F.lit(0))


def fill_defaults(df: DataFrame, spec: dict[str, object]) -> DataFrame:
    """Replace NULL by the typed default of each column in ``spec``, in one projection."""
    kinds = dict(df.dtypes)

    def filled(c: str) -> str:
        if c not in spec:
            return f"`{c}`"
        value = f"'{spec[c]}'" if isinstance(spec[c], str) else spec[c]
        return f"coalesce(`{c}`, CAST({value} AS {kinds[c]})) AS `{c}`"

    return df.selectExpr(*[filled(c) for c in df.columns])


def attach(df: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    """``df`` with the other columns of ``lookup``, which has one row per (NULL-able) key set."""
    right = lookup.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in lookup.columns if c not in keys])
    on = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return df.join(right, on, "left").drop(*[f"_r_{k}" for k in keys])
