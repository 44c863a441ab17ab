"""Staging: raw tables to clean, typed columns.  Narrow projections only, no shuffle."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import rulebook as R
from ..functions import scalars as X
from ..functions.ladders import ilike_any


def rename_passthrough(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Keep exactly the mapped columns, renamed ``{old: new}``."""
    return df.select(*[F.col(old).alias(new) for old, new in mapping.items()])


def append(df: DataFrame, **exprs: Column) -> DataFrame:
    """Every existing column plus the named ones, in one projection."""
    return df.withColumns(exprs)


def coalesce_v(df: DataFrame, sentinel: float = S.NUM_SENTINEL) -> list[Column]:
    """One sentinel-filled column per discovered ``V<digits>`` column."""
    return sentinel_columns(S.v_columns(df), sentinel)


def sentinel_columns(names: list[str], sentinel: float | str) -> list[Column]:
    """``coalesce(name, sentinel) AS name`` for every name."""
    literal = f"'{sentinel}'" if isinstance(sentinel, str) else f"{sentinel}D"
    return [F.expr(f"coalesce({c}, {literal}) AS {c}") for c in names]


def stg_transaction(raw: DataFrame) -> DataFrame:
    """Time parts, amount forms, cleaned categories and sentinel-filled numerics."""
    dt, amount = F.col("TransactionDT"), F.col(S.AMOUNT)
    columns: dict[str, Column] = {
        S.KEY: F.col(S.KEY),
        S.LABEL: F.col(S.LABEL),
        "TransactionDT": dt,
        "txn_hour": X.hour_of(dt),
        "txn_day_of_week": X.dow_of(dt),
        S.DAY: X.day_of(dt),
        S.AMOUNT: amount,
        "log_txn_amt": X.log_amt(amount),
        "amt_decimal_part": X.amt_decimal(amount),
        **{c: F.col(c) for c in ("ProductCD", "card1", "card2", "card3", "card5")},
        **{f"{c}_clean": X.str_or_unknown(F.col(c)) for c in ("card4", "card6")},
        **{f"{c}_clean": X.num_or_sentinel(F.col(c)) for c in ("addr1", "addr2", "dist1", "dist2")},
    }
    for side in "pr":
        domain = F.col(f"{side.upper()}_emaildomain")
        columns[f"{side}_email_clean"] = X.str_or_unknown(domain)
        columns[f"{side}_email_group"] = R.EMAIL_GROUP.column(f"{side.upper()}_emaildomain")
    columns |= {f"m{k}_flag": X.flag(F.col(f"M{k}")) for k in S.MATCH_FLAGS}
    columns["m4_clean"] = X.str_or_unknown(F.col("M4"))
    return raw.select(
        *[c.alias(n) for n, c in columns.items()],
        *sentinel_columns(S.COUNT_COLUMNS + S.GAP_COLUMNS, S.NUM_SENTINEL),
        *coalesce_v(raw),
    )


def stg_identity(raw: DataFrame) -> DataFrame:
    """Device, browser and operating-system groups, screen size and cleaned ``id_*`` columns."""
    os, browser, device = F.col("id_30"), F.col("id_31"), F.col("DeviceInfo")
    # Folded once here; the optimizer keeps this projection apart because the ladders below read
    # each folded text many times.
    folded = raw.select(
        "*",
        F.lower(os).alias("_os"),
        F.lower(browser).alias("_browser"),
        F.lower(device).alias("_device"),
        X.chrome_major(F.lower(browser)).alias("_chrome"),
    )
    columns: dict[str, Column] = {
        S.KEY: F.col(S.KEY),
        "device_type": X.str_or_unknown(F.col("DeviceType")),
        "DeviceInfo": device,
        "os_group": R.STG_OS_GROUP.column("id_30", "_os"),
        "os_version_group": R.STG_OS_VERSION.column("id_30", "_os"),
        "browser_family": R.STG_BROWSER_FAMILY.column("id_31", "_browser"),
        "chrome_version_bucket": X.chrome_bucket(F.col("_browser"), F.col("_chrome"), R.STG_CHROME_BUCKETS),
        "is_exotic_browser": X.is_exotic(browser, R.EXOTIC_BROWSERS),
        "device_manufacturer": R.STG_MANUFACTURER.column("DeviceInfo", "_device"),
        "samsung_tier": R.STG_SAMSUNG_TIER.column("DeviceInfo", "_device"),
        "is_old_android_budget_device": F.when(
            ilike_any(os, *R.OLD_ANDROID) & ilike_any(device, *R.BUDGET_BRANDS), 1
        ).otherwise(0),
        "no_browser_os_signal": X.no_signal(os, browser),
        "screen_width": X.screen_part(F.col("id_33"), 1),
        "screen_height": X.screen_part(F.col("id_33"), 2),
        "id_34_match_status": X.match_status(F.col("id_34")),
        **{f"{c}_flag": X.bool_flag(F.col(c)) for c in S.ID_BOOLEAN},
    }
    return folded.select(
        *[c.alias(n) for n, c in columns.items()],
        *sentinel_columns(S.ID_NUMERIC, S.NUM_SENTINEL),
        *sentinel_columns(S.ID_TEXT, S.TEXT_SENTINEL),
    )
