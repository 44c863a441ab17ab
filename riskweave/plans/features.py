"""Feature table: join, time parts, velocity, final projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import scalars as X
from ..operators.joins import HIT, fill_defaults, has_identity, join_identity
from ..operators.rolling import velocity
from .staging import append, stg_identity, stg_transaction


def int_joined(transactions: DataFrame, identities: DataFrame) -> DataFrame:
    """All staged transactions with identity columns; typed defaults where there is no match."""
    wanted = identities.select(S.KEY, *S.IDENTITY_DEFAULTS)
    joined = join_identity(transactions, wanted)
    filled = fill_defaults(joined, S.IDENTITY_DEFAULTS)
    return filled.withColumn("has_identity", has_identity(F.col(HIT))).drop(HIT)


def feat_time(joined: DataFrame) -> DataFrame:
    """Night flag and named part of the day."""
    hour = F.col("txn_hour")
    return append(joined, is_night_transaction=X.is_night(hour), txn_time_bucket=X.time_bucket(hour))


def feat_velocity(
    timed: DataFrame,
    strategy: str = "daily",
    strict: bool = False,
    source: DataFrame | None = None,
) -> DataFrame:
    """Rolling card, e-mail and customer activity; see :func:`velocity`."""
    return velocity(timed, strategy=strategy, strict=strict, source=source)


def feat_final(df: DataFrame, include_v: bool = False) -> DataFrame:
    """The fixed feature columns; the discovered V columns follow on request."""
    return df.select(*S.FEATURE_COLUMNS, *(S.v_columns(df) if include_v else []))


def build(
    raw_transaction: DataFrame,
    raw_identity: DataFrame,
    strategy: str = "daily",
    strict: bool = False,
    include_v: bool = False,
) -> DataFrame:
    """Raw tables to the feature table, as one lazy plan.

    Relies on at most one identity row per transaction (``duplicate_keys`` checks that), so the
    joined table and the staged transactions hold the same rows.
    """
    transactions = stg_transaction(raw_transaction)
    timed = feat_time(int_joined(transactions, stg_identity(raw_identity)))
    return feat_final(feat_velocity(timed, strategy, strict, source=transactions), include_v)
