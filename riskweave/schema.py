"""Column roles of the raw, feature, scoring and result tables."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import types as T

KEY = "TransactionID"
LABEL = "isFraud"
AMOUNT = "TransactionAmt"
DAY = "txn_day_number"

NUM_SENTINEL = -999.0
TEXT_SENTINEL = "unknown"

#: Money is summed as exact decimals, so totals do not depend on partitioning or task retries.
#: Eighteen digits behind the point hold every amount from a hundredth of a cent down as written;
#: a total beyond 10**20 raises.
MONEY = "decimal(38,18)"

COUNT_COLUMNS = [f"C{k}" for k in range(1, 15)]
GAP_COLUMNS = [f"D{k}" for k in range(1, 16)]
MATCH_FLAGS = [k for k in range(1, 10) if k != 4]

ID_NUMERIC = [f"id_{k:02d}" for k in (*range(1, 12), 13, 14, *range(17, 23), 24, 25, 26, 32)]
ID_TEXT = [f"id_{k}" for k in (12, 15, 16, 23, 27, 28, 29)]
ID_BOOLEAN = [f"id_{k}" for k in range(35, 39)]
ID_FLAGS = [f"{c}_flag" for c in ID_BOOLEAN]

DEVICE_TEXT = [
    "device_type", "os_group", "os_version_group", "browser_family",
    "chrome_version_bucket", "device_manufacturer", "samsung_tier",
]
DEVICE_FLAGS = ["is_exotic_browser", "is_old_android_budget_device", "no_browser_os_signal"]
SCREEN = ["screen_width", "screen_height", "id_34_match_status"]

#: What a transaction without identity row receives for every identity-side column (47 columns).
IDENTITY_DEFAULTS: dict[str, object] = {
    **{c: TEXT_SENTINEL for c in DEVICE_TEXT + ID_TEXT},
    **{c: 0 for c in DEVICE_FLAGS + ID_FLAGS},
    **{c: NUM_SENTINEL for c in ID_NUMERIC},
    **{c: -999 for c in SCREEN},
}

VELOCITY = [
    "card1_txn_count_7d", "card1_amt_sum_7d", "card1_avg_amt_30d",
    "amt_to_card_avg_ratio", "email_txn_count_7d", "uid", "uid_txn_count_30d",
]

FEATURE_COLUMNS = [
    KEY, LABEL,
    "txn_hour", "txn_day_of_week", DAY, "is_night_transaction", "txn_time_bucket",
    AMOUNT, "log_txn_amt", "amt_decimal_part",
    "ProductCD", "card1", "card2", "card3", "card4_clean", "card5", "card6_clean",
    "addr1_clean", "addr2_clean", "dist1_clean", "dist2_clean",
    "p_email_clean", "r_email_clean", "p_email_group", "r_email_group",
    "m1_flag", "m2_flag", "m3_flag", "m4_clean",
    "m5_flag", "m6_flag", "m7_flag", "m8_flag", "m9_flag",
    *COUNT_COLUMNS, *GAP_COLUMNS,
    "device_type", "os_group", "os_version_group", "browser_family",
    "chrome_version_bucket", "is_exotic_browser", "device_manufacturer", "samsung_tier",
    "no_browser_os_signal", "is_old_android_budget_device", "has_identity",
    # fixed order of the identity columns
    *[f"id_{k:02d}" for k in range(1, 12)],
    "id_12", "id_15", "id_16", "id_13", "id_14",
    "id_17", "id_18", "id_19", "id_20", "id_21", "id_22", "id_24", "id_25", "id_26",
    "id_23", "id_27", "id_28", "id_29", "id_32",
    *SCREEN, *ID_FLAGS,
    *VELOCITY,
]

#: Model input, by role.
CATEGORICAL = [
    "ProductCD", "card4_clean", "card6_clean", "p_email_group", "r_email_group",
    *DEVICE_TEXT, "m4_clean", *ID_TEXT,
]
NUMERIC = [
    "txn_hour", "txn_day_of_week", "is_night_transaction",
    "log_txn_amt", "amt_decimal_part",
    "card1", "card2", "card3", "card5",
    "addr1_clean", "addr2_clean", "dist1_clean", "dist2_clean",
    *[f"m{k}_flag" for k in MATCH_FLAGS],
    *COUNT_COLUMNS, *GAP_COLUMNS,
    "has_identity", "is_exotic_browser", "no_browser_os_signal", "is_old_android_budget_device",
    *ID_NUMERIC, *SCREEN, *ID_FLAGS,
    "card1_txn_count_7d", "card1_amt_sum_7d", "card1_avg_amt_30d",
    "amt_to_card_avg_ratio", "email_txn_count_7d", "uid_txn_count_30d",
]

#: Columns of the feature table that may never be NULL.
REQUIRED = [
    KEY, LABEL, "txn_hour", "txn_day_of_week", DAY, "log_txn_amt", AMOUNT, "card1",
    "card1_txn_count_7d", "card1_amt_sum_7d", "email_txn_count_7d", "uid_txn_count_30d",
    "is_night_transaction", "is_exotic_browser", "no_browser_os_signal",
    "is_old_android_budget_device", "has_identity",
]


_RAW_TRANSACTION_TYPES = {
    KEY: "bigint", LABEL: "int", "TransactionDT": "bigint", AMOUNT: "double", "ProductCD": "string",
    "card1": "bigint", "card2": "bigint", "card3": "bigint", "card4": "string",
    "card5": "bigint", "card6": "string",
    "addr1": "double", "addr2": "double", "dist1": "double", "dist2": "double",
    "P_emaildomain": "string", "R_emaildomain": "string",
    **{c: "double" for c in COUNT_COLUMNS + GAP_COLUMNS},
    **{f"M{k}": "string" for k in range(1, 10)},
}
_RAW_IDENTITY_TYPES = {
    KEY: "bigint", "DeviceType": "string", "DeviceInfo": "string",
    "id_30": "string", "id_31": "string", "id_33": "string", "id_34": "string",
    **{c: "boolean" for c in ID_BOOLEAN},
    **{c: "double" for c in ID_NUMERIC},
    **{c: "string" for c in ID_TEXT},
}


def v_columns(df_or_names: DataFrame | list[str]) -> list[str]:
    """Vendor feature columns ``V<digits>``, in table order; the set is discovered, never listed."""
    names = df_or_names.columns if isinstance(df_or_names, DataFrame) else df_or_names
    return [c for c in names if re.fullmatch(r"[Vv]\d+", c)]


_TYPES = {
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
}


def _struct(columns: dict[str, str]) -> T.StructType:
    return T.StructType([T.StructField(c, _TYPES[kind]) for c, kind in columns.items()])


def raw_transaction_schema(v_names: list[str] = ()) -> T.StructType:
    """Schema of the raw transaction table plus whatever V columns the source carries."""
    return _struct({**_RAW_TRANSACTION_TYPES, **{v: "double" for v in v_names}})


def raw_identity_schema() -> T.StructType:
    return _struct(_RAW_IDENTITY_TYPES)
