"""Raw fraud tables derived, row for row, from the generic test tables.

``events`` becomes the transaction and the identity table, ``orders`` a long-running velocity
input.  Every expression is a pure function of the row, so the views grow with their tables and
give the same rows in any engine (see ``FIXTURES.md``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import schema as S

# Fixed values of the fixtures.
CARD4 = ["visa", "mastercard", "discover", None]
CARD6 = ["debit", "credit", None]
P_EMAIL = [
    "gmail.com", "yahoo.com", "outlook.com", "hotmail.com",
    None, "anonymous.com", "Gmail.com", "mail.com",
]
R_EMAIL = ["gmail.com", None, "hotmail.com", "yahoo.com.mx", "aol.com"]
MATCH = ["T", "F", None]
M4 = ["M0", "M1", "M2", None]
DEVICE_TYPE = ["desktop", "mobile", None]
SCREENS = ["1920x1080", "2208x1242", "1334x750", "bad", "800x", None]
MATCH_STATUS = ["match_status:2", "match_status:1", "match_status:0", "match_status:-1", None]
FOUND = ["Found", "NotFound", None]
ID_15 = ["Found", "New", "Unknown", None]
ID_23 = ["IP_PROXY:HIDDEN", "IP_PROXY:ANONYMOUS", "IP_PROXY:TRANSPARENT", None]
OS = [
    "Windows 10", "Windows 7", "Windows 8.1", "Windows Vista", "Windows XP", "iOS 11.1.2",
    "iOS 10.3.3", "iOS 9.3.5", "Android 8.0.0", "Android 7.0", "Android 6.0.1", "Android 5.1.1",
    "Android 4.4.2", "Mac OS X 10_13_1", "Mac OS X 10.12.6", "Mac OS X 10_11_6", "Mac OS X 10_9_5",
    "Mac", "Linux", "other", "Windows", "Android", None,
]
BROWSERS = [
    "samsung browser 6.2", "mobile safari 11.0", "safari generic", "chrome 63.0 for android",
    "chrome 62.0 for ios", "chrome 49.0", "Chrome 57.0", "chrome 64.0", "chrome 66.0",
    "chrome generic", "firefox 57.0", "edge 15.0", "ie 11.0 for desktop", "opera 49.0",
    "android webview 4.0", "mobile safari uiwebview", "silk", "palemoon", "Palemoon",
    "google search application 48.0", None,
]
DEVICES = [
    "SAMSUNG SM-G892A Build/NRD90M", "SM-J700M Build/MMB29K", "SM-G531H Build/LMY48B",
    "SAMSUNG SM-G532M", "GT-I9060M", "SCH-I545", "Moto G (4)", "XT1635-02", "LG-D320", "LGMS210",
    "HUAWEI VNS-L31", "Redmi Note 4", "Mi A1", "Pixel 2", "Nexus 5X", "HTC One", "Lenovo A6020",
    "TA-1039", "Nokia 6", "ZTE BLADE A6", "Alcatel 5044R", "BLU DASH M", "Ilium X210", "KFFOWI",
    "Windows", "rv:11.0", "Trident/7.0", "iOS Device", "F3113 Build/33", "ONEPLUS A3003", None,
]
N_V = 8


def _pick(values: list, index: str) -> str:
    items = ", ".join("CAST(NULL AS STRING)" if v is None else f"'{v}'" for v in values)
    return f"array({items})[CAST({index} AS INT)]"


def _null_if(test: str, value: str) -> str:
    return f"CASE WHEN {test} THEN NULL ELSE {value} END"


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/events.parquet")


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


_IS_FRAUD = "CASE WHEN event_type = 'error' AND event_id % 6 = 0 THEN 1 ELSE 0 END"
_SECONDS = (
    "CAST(datediff(to_date(ts), DATE'2024-01-01') AS BIGINT) * 86400"
    " + hour(ts) * 3600 + minute(ts) * 60 + second(ts) + 86400"
)


def raw_transaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One transaction per event."""
    e, u = "event_id", "user_id"
    columns = {
        S.KEY: e,
        S.LABEL: _IS_FRAUD,
        "TransactionDT": _SECONDS,
        S.AMOUNT: "value",
        "ProductCD": "upper(substring(event_type, 1, 1))",
        "card1": u,
        "card2": _null_if(f"{e} % 11 = 0", f"{u} % 17"),
        "card3": "150L",
        "card4": _pick(CARD4, f"{u} % 4"),
        "card5": f"100 + {u} % 9",
        "card6": _pick(CARD6, f"{u} % 3"),
        "addr1": _null_if(f"{e} % 9 = 0", f"CAST(100 + {u} % 20 AS DOUBLE)"),
        "addr2": _null_if(f"{e} % 9 = 0", "87.0D"),
        "dist1": _null_if(f"{e} % 5 < 3", f"CAST({e} % 300 AS DOUBLE)"),
        "dist2": _null_if(f"{e} % 16 <> 0", f"CAST({e} % 700 AS DOUBLE)"),
        "P_emaildomain": _pick(P_EMAIL, f"{u} % 8"),
        "R_emaildomain": _pick(R_EMAIL, f"{e} % 5"),
    }
    for k in range(1, 15):
        columns[f"C{k}"] = _null_if(f"({e} + {k}) % 13 = 0", f"CAST(({e} * {k}) % 7 AS DOUBLE)")
    for k in range(1, 16):
        columns[f"D{k}"] = _null_if(f"({e} + {k}) % 3 = 0", f"CAST(({e} * {k}) % 90 AS DOUBLE)")
    for k in range(1, 10):
        columns[f"M{k}"] = _pick(M4, f"{e} % 4") if k == 4 else _pick(MATCH, f"({e} + {k}) % 3")
    for k in range(1, N_V + 1):
        columns[f"V{k}"] = _null_if(f"({e} + {k}) % 4 <> 0", f"CAST(({e} * {k}) % 10 AS DOUBLE)")
    columns["VX"] = "'x'"
    return _select(_events(spark, sf_dir), columns)


def raw_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identity rows.  Three of four transactions have none: that is the data model, and what
    the outer join and its defaults are for."""
    q = "(event_id div 4)"
    columns = {
        S.KEY: "event_id",
        "DeviceType": _pick(DEVICE_TYPE, f"{q} % 3"),
        "DeviceInfo": _pick(DEVICES, f"{q} % 31"),
        "id_30": _pick(OS, f"{q} % 23"),
        "id_31": _pick(BROWSERS, f"{q} % 21"),
        "id_33": _pick(SCREENS, f"{q} % 6"),
        "id_34": _pick(MATCH_STATUS, f"{q} % 5"),
    }
    for k in range(35, 39):
        columns[f"id_{k}"] = f"CAST({_pick(MATCH, f'({q} + {k}) % 3')} AS BOOLEAN)"
    for c in S.ID_NUMERIC:
        k = int(c[3:])
        columns[c] = _null_if(f"({q} + {k}) % 4 = 0", f"CAST(({q} * {k}) % 100 - 50 AS DOUBLE)")
    for k in (12, 16, 27, 28, 29):
        columns[f"id_{k}"] = _pick(FOUND, f"({q} + {k}) % 3")
    columns["id_15"] = _pick(ID_15, f"{q} % 4")
    columns["id_23"] = _pick(ID_23, f"{q} % 4")
    with_identity = _events(spark, sf_dir).filter("event_id % 4 = 0")
    return _select(with_identity, columns)


def velocity_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as transactions over years of days, with a few very heavy keys."""
    return _select(
        spark.read.parquet(f"{sf_dir}/orders.parquet"),
        {
            S.KEY: "o_orderkey",
            S.DAY: "CAST(datediff(to_date(o_orderdate), DATE'1995-01-01') AS BIGINT)",
            S.AMOUNT: "o_totalprice",
            "card1": "o_custkey % 50",
            "p_email_clean": "o_orderpriority",
            "addr1_clean": "CASE WHEN o_orderkey % 10 = 0 THEN -999.0D ELSE CAST(o_custkey % 7 AS DOUBLE) END",
        },
    )


def pseudo_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A score with many ties that separates the classes, for evaluation without a model."""
    return _select(
        _events(spark, sf_dir),
        {
            S.KEY: "event_id",
            S.LABEL: _IS_FRAUD,
            "score": f"CAST((event_id * 7919) % 1000 + 400 * ({_IS_FRAUD}) AS DOUBLE) / 1400.0D",
            S.AMOUNT: "value",
        },
    )


#: Two small ensembles over columns of the feature table, for evaluation without training: per
#: tree its nodes as (feature, threshold, left, right, gain, rows) or (value, rows) for a leaf.
ENSEMBLE_COLUMNS = ["C1", "D2", "is_night_transaction", "card1_txn_count_7d", "has_identity"]
ENSEMBLES = {
    "mixed": (
        -0.5,
        [
            [("C1", 3.5, 1, 2, 8.0, 100), (-0.75, 60), ("D2", 40.5, 3, 4, 2.5, 40), (-0.125, 30), (0.875, 10)],
            [("is_night_transaction", 0.5, 1, 2, 3.0, 90), (-0.0625, 70), (0.375, 20)],
            [("card1_txn_count_7d", 2.5, 1, 2, 1.5, 80), (0.25, 16), (-0.1875, 64)],
        ],
    ),
    "stumps": (
        0.25,
        [
            [("C1", 2.5, 1, 2, 4.0, 64), (-0.5, 16), (0.5, 48)],
            [("D2", 30.5, 1, 2, 2.0, 64), (0.25, 32), (-0.75, 32)],
            [("C1", 4.5, 1, 2, 1.0, 64), (-0.25, 48), (0.125, 16)],
            [("has_identity", 0.5, 1, 2, 5.0, 64), (0.0625, 56), (0.5, 8)],
        ],
    ),
}
