"""Profiling queries over the raw tables.

Text ladders are evaluated on the identity rows before the join, so the join carries short labels
instead of free text and the ladders never run for transactions without identity.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schema as S
from ..functions import rulebook as R
from ..functions import scalars as X
from ..functions.ladders import Ladder
from ..operators.joins import HIT, identity_with_label, join_identity
from ..operators.rates import fraud_rate, order_by_rate, require_not_null, top


def fraud_rate_hour_dow(t: DataFrame, n: int = 20) -> DataFrame:
    """Hours of the relative week with the highest fraud rate."""
    dt = F.col("TransactionDT")
    keys = {"hour_of_day": X.hour_of(dt), "day_of_week": X.dow_of(dt)}
    return top(fraud_rate(t, keys), n, ties=list(keys))


def fraud_rate_email(t: DataFrame, min_total: int = 500, n: int = 20) -> DataFrame:
    """Purchaser domains with the highest fraud rate among the frequent ones."""
    domain = "P_emaildomain"
    return top(fraud_rate(require_not_null(t, domain), [domain], min_total=min_total), n, ties=[domain])


def _labels(i: DataFrame, **ladders: tuple[Ladder, str]) -> DataFrame:
    """Identity keys with the group of each named text column."""
    texts = list(dict.fromkeys(text for _, text in ladders.values()))
    folded = i.select("*", *[F.lower(t).alias(f"_{t}") for t in texts])
    others = [c for c in ("DeviceType",) if c in i.columns]
    return folded.select(
        S.KEY, *others, *[ladder.column(text, f"_{text}").alias(n) for n, (ladder, text) in ladders.items()]
    )


def _joined(t: DataFrame, i: DataFrame, **ladders: tuple[Ladder, str]) -> DataFrame:
    """Key, label, device type and groups of every transaction."""
    joined = join_identity(t.select(S.KEY, S.LABEL), _labels(i, **ladders))
    missing = {n: F.coalesce(F.col(n), F.lit(ladder.if_null)) for n, (ladder, _) in ladders.items()}
    return joined.withColumns(missing) if missing else joined


def fraud_rate_device_type(t: DataFrame, i: DataFrame) -> DataFrame:
    """Fraud rate per device type; transactions without one form the NULL group."""
    return order_by_rate(fraud_rate(_joined(t, i.select(S.KEY, "DeviceType")), ["DeviceType"]), ["DeviceType"])


def fraud_rate_os_version(t: DataFrame, i: DataFrame) -> DataFrame:
    key = "os_version_group"
    joined = _joined(t, i, **{key: (R.EDA_OS_VERSION_RATE, "id_30")})
    return order_by_rate(fraud_rate(joined, [key]), [key])


def fraud_rate_manufacturer(t: DataFrame, i: DataFrame) -> DataFrame:
    key = "device_manufacturer"
    joined = _joined(t, i, **{key: (R.EDA_MANUFACTURER_RATE, "DeviceInfo")})
    return order_by_rate(fraud_rate(joined, [key]), [key])


def fraud_rate_device_group(t: DataFrame, i: DataFrame) -> DataFrame:
    """Fraud rate with missing devices told apart from missing identities."""
    joined = _joined(t, i.select(S.KEY, "DeviceType"))
    groups = {"device_group": X.device_group(F.col("DeviceType"), F.col(HIT))}
    return order_by_rate(fraud_rate(joined, groups), ["device_group"])


def os_features(t: DataFrame, i: DataFrame) -> DataFrame:
    """Operating-system family and version of every transaction."""
    ladders = {"os_family": (R.EDA_OS_FAMILY, "id_30"), "os_version_group": (R.EDA_OS_VERSION, "id_30")}
    return _joined(t, i, **ladders).select(S.KEY, *ladders)


def browser_features(t: DataFrame, i: DataFrame) -> DataFrame:
    """Browser family, Chrome version bucket and rare-browser flag of every transaction."""
    browser = F.col("id_31")
    folded = i.select(S.KEY, browser, F.lower(browser).alias("_browser"))
    versions = folded.select("*", X.chrome_major("_browser").alias("_chrome"))
    labels = versions.select(
        S.KEY,
        R.EDA_BROWSER_FAMILY.column("id_31", "_browser").alias("browser_family"),
        X.chrome_bucket(F.col("_browser"), F.col("_chrome"), R.EDA_CHROME_BUCKETS).alias("chrome_version_bucket"),
        X.is_exotic(browser, R.EXOTIC_BROWSERS).alias("is_exotic_browser"),
    )
    return join_identity(t.select(S.KEY), labels).select(
        S.KEY,
        F.coalesce("browser_family", F.lit(R.EDA_BROWSER_FAMILY.if_null)).alias("browser_family"),
        "chrome_version_bucket",
        X.flag_or_zero(F.col("is_exotic_browser")).alias("is_exotic_browser"),
    )


def device_features(i: DataFrame, t: DataFrame) -> DataFrame:
    """Manufacturer and Samsung tier of every identity row, with the label of its transaction.

    The identity side is the preserved one here.
    """
    ladders = {
        "device_manufacturer": (R.EDA_MANUFACTURER, "DeviceInfo"),
        "samsung_tier": (R.EDA_SAMSUNG_TIER, "DeviceInfo"),
    }
    labelled = identity_with_label(_labels(i, **ladders), t)
    return labelled.select(S.KEY, *ladders, S.LABEL)


def segment_features(t: DataFrame, i: DataFrame) -> DataFrame:
    """Key, label and the four dimensions of the segment dashboard."""
    return _joined(
        t, i,
        os_family=(R.EDA_OS_FAMILY, "id_30"),
        browser_family=(R.DASHBOARD_BROWSER_FAMILY, "id_31"),
        device_manufacturer=(R.DASHBOARD_MANUFACTURER, "DeviceInfo"),
    )


def segment_dashboard(t: DataFrame, i: DataFrame) -> DataFrame:
    """Fraud rate of every (system, browser, manufacturer, device type) segment."""
    keys: list[str | Column] = ["os_family", "browser_family", "device_manufacturer", "DeviceType"]
    return order_by_rate(fraud_rate(segment_features(t, i), keys), keys)
