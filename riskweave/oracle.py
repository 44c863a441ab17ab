"""The same answers in plain SQL for an independent engine (DuckDB dialect).

Each text is one statement over the test tables.  It shares the fixed values with the library --
column lists, ladders, fixture lists -- and none of its logic: windows are direct frames, medians
are the engine's own, the split is a row number, rates are divided row by row.
"""

from __future__ import annotations

from . import fixtures as X
from . import schema as S
from .functions import rulebook as R
from .functions.ladders import Except, Ladder, Names
from .operators.evaluate import BLOCK_SCORE, FINE_GRID, FRAUD_LOSS, GRID, REVIEW_COST


# ---------------------------------------------------------------- rendering helpers

def _text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(values: list, index: str) -> str:
    items = ", ".join("CAST(NULL AS VARCHAR)" if v is None else _text(v) for v in values)
    return f"[{items}][CAST({index} AS INT) + 1]"


def _case(ladder: Ladder, column: str) -> str:
    match = "LIKE" if ladder.case_sensitive else "ILIKE"

    def holds(test) -> str:
        if isinstance(test, Names):
            return f"{column} IN ({', '.join(map(_text, test.values))})"
        if isinstance(test, Except):
            return f"({column} {match} {_text(test.pattern)} AND NOT {column} {match} {_text(test.unless)})"
        return f"{column} {match} {_text(test)}"

    arms = "\n".join(
        f"    WHEN {' OR '.join(map(holds, tests))} THEN {_text(label)}" for label, tests in ladder.arms
    )
    return f"CASE\n{arms}\n    WHEN {column} IS NULL THEN {_text(ladder.if_null)}\n    ELSE {_text(ladder.otherwise)} END"


def _chrome(column: str, buckets) -> str:
    bounds, newest, unreadable = buckets
    major = f"TRY_CAST(regexp_extract(lower({column}), 'chrome ([0-9]+)', 1) AS BIGINT)"
    arms = " ".join(f"WHEN {major} < {b} THEN {_text(n)}" for b, n in bounds)
    newest_arm = f"WHEN {major} >= {bounds[-1][0]} THEN {_text(newest)}"
    return f"CASE WHEN {column} ILIKE '%chrome%' THEN CASE {arms} {newest_arm} ELSE {_text(unreadable)} END END"


def _any(column: str, patterns) -> str:
    return "(" + " OR ".join(f"{column} ILIKE {_text(p)}" for p in patterns) + ")"


def _half_up(num: str, den: str, scale: int, digits: int) -> str:
    p = 10**digits
    return f"CAST((({num}) * {2 * scale * p} + ({den})) // (2 * ({den})) AS DOUBLE) / {p}.0"


def _pct(num: str, den: str) -> str:
    return _half_up(num, den, 100, 2)


def _columns(pairs: dict[str, str]) -> str:
    return ",\n  ".join(f"{expr} AS {name}" for name, expr in pairs.items())


# ---------------------------------------------------------------- views

def _raw_transaction() -> str:
    e, u = "event_id", "user_id"
    unless = "CASE WHEN {} THEN NULL ELSE {} END".format
    cols = {
        S.KEY: e,
        S.LABEL: "CASE WHEN event_type = 'error' AND event_id % 6 = 0 THEN 1 ELSE 0 END",
        "TransactionDT": "CAST(epoch_us(ts) // 1000000 - 1704067200 + 86400 AS BIGINT)",
        S.AMOUNT: "value",
        "ProductCD": "upper(substr(event_type, 1, 1))",
        "card1": u,
        "card2": unless(f"{e} % 11 = 0", f"{u} % 17"),
        "card3": "CAST(150 AS BIGINT)",
        "card4": _pick(X.CARD4, f"{u} % 4"),
        "card5": f"100 + {u} % 9",
        "card6": _pick(X.CARD6, f"{u} % 3"),
        "addr1": unless(f"{e} % 9 = 0", f"CAST(100 + {u} % 20 AS DOUBLE)"),
        "addr2": unless(f"{e} % 9 = 0", "CAST(87 AS DOUBLE)"),
        "dist1": unless(f"{e} % 5 < 3", f"CAST({e} % 300 AS DOUBLE)"),
        "dist2": unless(f"{e} % 16 <> 0", f"CAST({e} % 700 AS DOUBLE)"),
        "P_emaildomain": _pick(X.P_EMAIL, f"{u} % 8"),
        "R_emaildomain": _pick(X.R_EMAIL, f"{e} % 5"),
    }
    for k in range(1, 15):
        cols[f"C{k}"] = unless(f"({e} + {k}) % 13 = 0", f"CAST(({e} * {k}) % 7 AS DOUBLE)")
    for k in range(1, 16):
        cols[f"D{k}"] = unless(f"({e} + {k}) % 3 = 0", f"CAST(({e} * {k}) % 90 AS DOUBLE)")
    for k in range(1, 10):
        cols[f"M{k}"] = _pick(X.M4, f"{e} % 4") if k == 4 else _pick(X.MATCH, f"({e} + {k}) % 3")
    for k in range(1, X.N_V + 1):
        cols[f"V{k}"] = unless(f"({e} + {k}) % 4 <> 0", f"CAST(({e} * {k}) % 10 AS DOUBLE)")
    cols["VX"] = "'x'"
    return f"SELECT\n  {_columns(cols)}\nFROM events"


def _raw_identity() -> str:
    q = "(event_id // 4)"
    cols = {
        S.KEY: "event_id",
        "DeviceType": _pick(X.DEVICE_TYPE, f"{q} % 3"),
        "DeviceInfo": _pick(X.DEVICES, f"{q} % 31"),
        "id_30": _pick(X.OS, f"{q} % 23"),
        "id_31": _pick(X.BROWSERS, f"{q} % 21"),
        "id_33": _pick(X.SCREENS, f"{q} % 6"),
        "id_34": _pick(X.MATCH_STATUS, f"{q} % 5"),
    }
    for k in range(35, 39):
        cols[f"id_{k}"] = f"({_pick(X.MATCH, f'({q} + {k}) % 3')} = 'T')"
    for c in S.ID_NUMERIC:
        k = int(c[3:])
        cols[c] = f"CASE WHEN ({q} + {k}) % 4 = 0 THEN NULL ELSE CAST(({q} * {k}) % 100 - 50 AS DOUBLE) END"
    for k in (12, 16, 27, 28, 29):
        cols[f"id_{k}"] = _pick(X.FOUND, f"({q} + {k}) % 3")
    cols["id_15"] = _pick(X.ID_15, f"{q} % 4")
    cols["id_23"] = _pick(X.ID_23, f"{q} % 4")
    return f"SELECT\n  {_columns(cols)}\nFROM events WHERE event_id % 4 = 0"


def _stg_transaction() -> str:
    dt, amt = "TransactionDT", S.AMOUNT
    cols = {
        S.KEY: S.KEY, S.LABEL: S.LABEL, dt: dt,
        "txn_hour": f"CAST(floor(({dt} % 86400) / 3600) AS BIGINT)",
        "txn_day_of_week": f"CAST(floor(({dt} / 86400) % 7) AS BIGINT)",
        S.DAY: f"CAST(floor({dt} / 86400) AS BIGINT)",
        amt: amt,
        "log_txn_amt": f"round(ln({amt} + 1), 9)",
        "amt_decimal_part": f"round({amt} - floor({amt}), 4)",
    }
    cols |= {c: c for c in ("ProductCD", "card1", "card2", "card3", "card5")}
    cols |= {f"{c}_clean": f"coalesce({c}, 'unknown')" for c in ("card4", "card6")}
    cols |= {f"{c}_clean": f"coalesce({c}, -999)" for c in ("addr1", "addr2", "dist1", "dist2")}
    for side in "pr":
        domain = f"{side.upper()}_emaildomain"
        cols[f"{side}_email_clean"] = f"coalesce({domain}, 'unknown')"
        cols[f"{side}_email_group"] = _case(R.EMAIL_GROUP, domain)
    cols |= {f"m{k}_flag": f"CASE WHEN M{k} = 'T' THEN 1 ELSE 0 END" for k in S.MATCH_FLAGS}
    cols["m4_clean"] = "coalesce(M4, 'unknown')"
    v_names = [f"V{k}" for k in range(1, X.N_V + 1)]
    cols |= {c: f"coalesce({c}, -999)" for c in S.COUNT_COLUMNS + S.GAP_COLUMNS + v_names}
    return f"SELECT\n  {_columns(cols)}\nFROM raw_transaction"


def _stg_identity() -> str:
    exotic = f"CASE WHEN id_31 IN ({', '.join(map(_text, R.EXOTIC_BROWSERS))}) THEN 1 ELSE 0 END"
    cols = {
        S.KEY: S.KEY,
        "device_type": "coalesce(DeviceType, 'unknown')",
        "DeviceInfo": "DeviceInfo",
        "os_group": _case(R.STG_OS_GROUP, "id_30"),
        "os_version_group": _case(R.STG_OS_VERSION, "id_30"),
        "browser_family": _case(R.STG_BROWSER_FAMILY, "id_31"),
        "chrome_version_bucket": _chrome("id_31", R.STG_CHROME_BUCKETS),
        "is_exotic_browser": exotic,
        "device_manufacturer": _case(R.STG_MANUFACTURER, "DeviceInfo"),
        "samsung_tier": _case(R.STG_SAMSUNG_TIER, "DeviceInfo"),
        "is_old_android_budget_device": (
            f"CASE WHEN {_any('id_30', R.OLD_ANDROID)} AND {_any('DeviceInfo', R.BUDGET_BRANDS)} THEN 1 ELSE 0 END"
        ),
        "no_browser_os_signal": "CASE WHEN id_30 IS NULL AND id_31 IS NULL THEN 1 ELSE 0 END",
    }
    cols |= {c: f"coalesce({c}, -999)" for c in S.ID_NUMERIC}
    cols |= {c: f"coalesce({c}, 'unknown')" for c in S.ID_TEXT}
    cols["screen_width"] = "coalesce(TRY_CAST(split_part(id_33, 'x', 1) AS BIGINT), -999)"
    cols["screen_height"] = "coalesce(TRY_CAST(split_part(id_33, 'x', 2) AS BIGINT), -999)"
    cols["id_34_match_status"] = "coalesce(TRY_CAST(replace(id_34, 'match_status:', '') AS BIGINT), -999)"
    cols |= {f"{c}_flag": f"CASE WHEN {c} THEN 1 ELSE 0 END" for c in S.ID_BOOLEAN}
    return f"SELECT\n  {_columns(cols)}\nFROM raw_identity"


def _int_joined() -> str:
    filled = {c: f"coalesce(i.{c}, {_text(v) if isinstance(v, str) else v})" for c, v in S.IDENTITY_DEFAULTS.items()}
    filled["has_identity"] = f"CASE WHEN i.{S.KEY} IS NOT NULL THEN 1 ELSE 0 END"
    return f"SELECT t.*,\n  {_columns(filled)}\nFROM stg_transaction t LEFT JOIN stg_identity i ON t.{S.KEY} = i.{S.KEY}"


_TIME_BUCKET = (
    "CASE "
    + " ".join(f"WHEN txn_hour BETWEEN {a} AND {b} THEN '{n}'" for a, b, n in R.TIME_BUCKETS)
    + f" ELSE '{R.TIME_BUCKET_REST}' END"
)


def _frame(key: str, days: int, strict: bool = False) -> str:
    end = "1 PRECEDING" if strict else "CURRENT ROW"
    return f"(PARTITION BY {key} ORDER BY {S.DAY} RANGE BETWEEN {days} PRECEDING AND {end})"


def _velocity(source: str, strict: bool = False) -> str:
    money = f"CAST({S.AMOUNT} AS DECIMAL(18,4))"  # exact here: the test tables have cents
    card7, card30 = _frame("card1", 7, strict), _frame("card1", 30, strict)
    email7, uid30 = _frame("p_email_clean", 7, strict), _frame("uid", 30, strict)
    return f"""SELECT *, {S.AMOUNT} / nullif(card1_avg_amt_30d, 0) AS amt_to_card_avg_ratio FROM (
  SELECT *,
    count(*) OVER {card7} AS card1_txn_count_7d,
    CAST(sum({money}) OVER {card7} AS DOUBLE) AS card1_amt_sum_7d,
    CAST(sum({money}) OVER {card30} AS DOUBLE) / nullif(count({S.AMOUNT}) OVER {card30}, 0) AS card1_avg_amt_30d,
    count(*) OVER {email7} AS email_txn_count_7d,
    count(*) OVER {uid30} AS uid_txn_count_30d
  FROM (SELECT *, CAST(card1 AS VARCHAR) || '_' || CAST(addr1_clean AS VARCHAR) AS uid FROM {source}) keyed
) framed"""


def _tree(nodes: list[tuple], at: int = 0) -> str:
    """What a row gets from one tree of fixed nodes."""
    node = nodes[at]
    if len(node) == 2:
        return f"CAST({node[0]} AS DOUBLE)"
    return f"CASE WHEN {node[0]} <= {node[1]} THEN {_tree(nodes, node[2])} ELSE {_tree(nodes, node[3])} END"


def _margin(name: str) -> str:
    start, trees = X.ENSEMBLES[name]
    return " + ".join([f"CAST({start} AS DOUBLE)", *map(_tree, trees)])


def _stump_parts(feature: str) -> str:
    """What the stumps on one feature add to a row's margin beyond their mean over the rows."""
    parts = []
    for nodes in X.ENSEMBLES["stumps"][1]:
        root, *leaves = nodes
        if root[0] == feature:
            parts.append(f"({_tree(nodes)} - {sum(v * n for v, n in leaves) / root[5]!r})")
    return " + ".join(parts) or "CAST(0 AS DOUBLE)"


def _stored_compared() -> str:
    """Areas under both curves of the two fixed ensembles, from pairs and steps by definition."""
    return f"""
SELECT position, model, sum(pos * (2 * (n - fp) + neg)) / (2.0 * any_value(p) * any_value(n)) AS roc_auc,
  sum(pos * (tp / (tp + fp))) / any_value(p) AS pr_auc
FROM (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER g AS p, sum(neg) OVER g AS n
  FROM (SELECT position, model, score, count(*) FILTER ({S.LABEL} = 1) AS pos, count(*) FILTER ({S.LABEL} = 0) AS neg
    FROM stored_scores GROUP BY position, model, score) c
  WINDOW w AS (PARTITION BY position ORDER BY score DESC), g AS (PARTITION BY position)) t
GROUP BY position, model"""


_VIEWS = {
    "raw_transaction": _raw_transaction(),
    "raw_identity": _raw_identity(),
    "velocity_orders": f"""SELECT o_orderkey AS {S.KEY},
  CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS BIGINT) AS {S.DAY},
  o_totalprice AS {S.AMOUNT}, o_custkey % 50 AS card1, o_orderpriority AS p_email_clean,
  CASE WHEN o_orderkey % 10 = 0 THEN CAST(-999 AS DOUBLE) ELSE CAST(o_custkey % 7 AS DOUBLE) END AS addr1_clean
FROM orders""",
    "scores": f"""SELECT {S.KEY}, {S.LABEL},
  CAST(({S.KEY} * 7919) % 1000 + 400 * {S.LABEL} AS DOUBLE) / CAST(1400 AS DOUBLE) AS score, {S.AMOUNT}
FROM raw_transaction""",
    "stg_transaction": _stg_transaction(),
    "stg_identity": _stg_identity(),
    "int_joined": _int_joined(),
    "feat_time": f"""SELECT *, CASE WHEN txn_hour BETWEEN 0 AND 5 THEN 1 ELSE 0 END AS is_night_transaction,
  {_TIME_BUCKET} AS txn_time_bucket
FROM int_joined""",
    "feat_velocity": _velocity("feat_time"),
    "feat_final": f"SELECT {', '.join(S.FEATURE_COLUMNS)} FROM feat_velocity",
    # positions in time order
    "positioned": f"""SELECT *, row_number() OVER (ORDER BY {S.DAY}, {S.KEY}) AS position,
  count(*) OVER () AS n_rows FROM stg_transaction""",
    "parts": "SELECT *, CASE WHEN position <= floor(n_rows * 0.8) THEN 'train' ELSE 'validation' END AS part FROM positioned",
    "train_counts": f"""SELECT count(*) - sum({S.LABEL}) AS legit, sum({S.LABEL}) AS fraud
FROM parts WHERE part = 'train'""",
}

_VIEWS["stored_scores"] = " UNION ALL ".join(
    f"SELECT {i} AS position, '{candidate}' AS model, *, 1 / (1 + exp(-({_margin(name)}))) AS score FROM feat_final"
    for i, (name, candidate) in enumerate((("mixed", "boosted_trees"), ("stumps", "leafwise_trees")))
)
_VIEWS["stump_parts"] = " UNION ALL ".join(
    f"SELECT {S.KEY}, '{c}' AS feature, {_stump_parts(c)} AS contribution FROM feat_final" for c in X.ENSEMBLE_COLUMNS
)

# views each view reads
_NEEDS = {
    "stored_scores": ["feat_final"],
    "stump_parts": ["feat_final"],
    "scores": ["raw_transaction"],
    "stg_transaction": ["raw_transaction"],
    "stg_identity": ["raw_identity"],
    "int_joined": ["stg_transaction", "stg_identity"],
    "feat_time": ["int_joined"],
    "feat_velocity": ["feat_time"],
    "feat_final": ["feat_velocity"],
    "positioned": ["stg_transaction"],
    "parts": ["positioned"],
    "train_counts": ["parts"],
}


def _with(body: str, *views: str) -> str:
    """``body`` behind the views it names, each after the ones it reads."""
    ordered: list[str] = []

    def visit(view: str) -> None:
        for need in _NEEDS.get(view, []):
            visit(need)
        if view not in ordered:
            ordered.append(view)

    for view in views:
        visit(view)
    return "WITH " + ",\n".join(f"{v} AS (\n{_VIEWS[v]}\n)" for v in ordered) + f"\n{body}"


def _rates(keys: dict[str, str], source: str, tail: str = "") -> str:
    names = ", ".join(f"{expr} AS {name}" for name, expr in keys.items())
    return f"""SELECT *, {_pct('fraud_count', 'total')} AS fraud_rate_pct FROM (
  SELECT {names}, count(*) AS total, CAST(sum({S.LABEL}) AS BIGINT) AS fraud_count
  FROM {source} GROUP BY {', '.join(keys.values())}
) grouped {tail}"""


_JOIN = f"(SELECT t.*, i.* EXCLUDE ({S.KEY}), i.{S.KEY} AS hit FROM raw_transaction t LEFT JOIN raw_identity i ON t.{S.KEY} = i.{S.KEY}) j"


def _joined_rates(**keys: str) -> str:
    return _with(_rates(keys, _JOIN), "raw_transaction", "raw_identity")


def _kpi(key: str) -> str:
    return _with(_rates({key: key}, "feat_time"), "feat_time")


def _catalog() -> str:
    v_names = [f"V{k}" for k in range(1, X.N_V + 1)]
    types = [(f.name, f.dataType.simpleString()) for f in S.raw_transaction_schema(v_names)] + [("VX", "string")]
    # text files carry no width: whole numbers come back as bigint
    rows = [
        f"SELECT CAST({i} AS BIGINT) AS ordinal, '{c}' AS column_name, '{'bigint' if k == 'int' else k}' AS data_type,"
        f" count({c}) AS n_values FROM raw_transaction"
        for i, (c, k) in enumerate(types, start=1)
    ]
    return _with("\nUNION ALL ".join(rows), "raw_transaction")


def _null_counts(columns: list[str]) -> str:
    rows = [f"SELECT '{c}' AS col, count(*) - count({c}) AS null_count FROM raw_transaction" for c in columns]
    return _with("\nUNION ALL ".join(rows), "raw_transaction")


def _sentinel_fill() -> str:
    cols = {}
    v_names = [f"V{k}" for k in range(1, X.N_V + 1)]
    for f in S.raw_transaction_schema(v_names).fields:
        kind = f.dataType.simpleString()
        cols[f.name] = (
            f"CASE WHEN {f.name} IS NULL OR {f.name} = '-999' THEN 'unknown' ELSE {f.name} END"
            if kind == "string" else f"coalesce({f.name}, -999)"
        )
    cols["VX"] = "VX"
    return _with(f"SELECT {_columns(cols)} FROM raw_transaction", "raw_transaction")


_CURVE = f"""curve AS (
  SELECT score, pos, neg,
    sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
    sum(pos) OVER () AS p, sum(neg) OVER () AS n
  FROM (SELECT score, sum({S.LABEL}) AS pos, sum(1 - {S.LABEL}) AS neg FROM scores GROUP BY score) g
)"""


def _curve(body: str) -> str:
    return _with(f"SELECT 1", "scores").replace("\nSELECT 1", f",\n{_CURVE}\n{body}")


def _counts_at(t: str) -> str:
    return f"""sum(CASE WHEN score >= {t} AND {S.LABEL} = 1 THEN 1 ELSE 0 END) AS tp,
    sum(CASE WHEN score >= {t} AND {S.LABEL} = 0 THEN 1 ELSE 0 END) AS fp,
    sum(CASE WHEN score < {t} AND {S.LABEL} = 1 THEN 1 ELSE 0 END) AS fn,
    sum(CASE WHEN score < {t} AND {S.LABEL} = 0 THEN 1 ELSE 0 END) AS tn"""


def _costs(grid: list[float]) -> str:
    points = ", ".join(f"(CAST({t!r} AS DOUBLE))" for t in grid)

    def ratio(num: str, den: str) -> str:
        return f"CASE WHEN ({den}) > 0 THEN {_half_up(num, den, 1, 4)} ELSE 0.0 END"

    return f"""SELECT threshold, CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
  CAST(fn AS BIGINT) AS false_negatives, CAST(tn AS BIGINT) AS true_negatives,
  CAST({ratio('tp', 'tp + fp')} AS DOUBLE) AS precision, CAST({ratio('tp', 'tp + fn')} AS DOUBLE) AS recall,
  round(({ratio('tp', 'tp + fn')}) * 100, 2) AS fraud_caught_pct,
  {_half_up('fp', 'fp + tn', 100, 4)} AS false_alarm_rate_pct,
  CAST(fn * {FRAUD_LOSS} AS BIGINT) AS cost_missed_fraud, CAST(fp * {REVIEW_COST} AS BIGINT) AS cost_false_alarms,
  CAST(fn * {FRAUD_LOSS} + fp * {REVIEW_COST} AS BIGINT) AS total_cost
FROM (
  SELECT threshold, {_counts_at('threshold')}
  FROM scores, (VALUES {points}) AS grid(threshold) GROUP BY threshold
) counted"""


_TIER = "CASE WHEN score <= 0 THEN NULL " + " ".join(
    f"WHEN score <= CAST({u} AS DOUBLE) THEN '{n}'" for u, n in R.RISK_TIERS
) + " END"


def _histogram(bins: int) -> str:
    lo = "CASE WHEN hi = lo THEN lo - 0.5 ELSE lo END"
    step = f"CASE WHEN hi = lo THEN CAST(1 AS DOUBLE) / {bins} ELSE (hi - lo) / {bins} END"
    body = f"""SELECT {S.LABEL}, bin, lo + bin * step AS bin_start, count(*) AS n,
  count(*) / (any_value(class_rows) * step) AS density
FROM (
  SELECT *, CASE WHEN score < lo + raw * step THEN raw - 1
    WHEN score >= lo + (raw + 1) * step AND raw < {bins - 1} THEN raw + 1 ELSE raw END AS bin
  FROM (
    SELECT *, least(CAST(floor((score - lo) / step) AS BIGINT), {bins - 1}) AS raw
    FROM (
      SELECT s.{S.LABEL}, s.score, class_rows, {lo} AS lo, {step} AS step
      FROM scores s JOIN (
        SELECT {S.LABEL}, min(score) AS lo, max(score) AS hi, count(*) AS class_rows FROM scores GROUP BY {S.LABEL}
      ) b ON s.{S.LABEL} = b.{S.LABEL}
    ) sized
  ) guessed
) placed
GROUP BY {S.LABEL}, bin, lo, step"""
    return _with(body, "scores")


def _features(*ladders: tuple[str, str]) -> str:
    cols = ", ".join(f"{expr} AS {name}" for name, expr in ladders)
    return _with(f"SELECT {S.KEY}, {cols} FROM {_JOIN}", "raw_transaction", "raw_identity")


def _violations(source: str, columns: list[str]) -> str:
    return f"SELECT * FROM {source} WHERE {' OR '.join(f'{c} IS NULL' for c in columns)}"


def _rolling_orders() -> str:
    return _with(_velocity("velocity_orders"), "velocity_orders")


def _report() -> str:
    rows = [f"SELECT 'not_null:{c}' AS \"check\", count(*) - count({c}) AS violations FROM feat_final" for c in S.REQUIRED]
    rows.append(f"SELECT 'log_domain:{S.AMOUNT}', count(*) FILTER ({S.AMOUNT} <= -1) FROM feat_final")
    rows.append(
        f"SELECT 'unique:{S.KEY}', count(*) FROM (SELECT {S.KEY} FROM feat_final GROUP BY {S.KEY} HAVING count(*) > 1) d"
    )
    union = "\nUNION ALL ".join(rows)
    return _with(f"SELECT \"check\", violations, violations = 0 AS passed FROM (\n{union}\n) r", "feat_final")


def statements() -> dict[str, str]:
    """Query name to SQL text."""
    device_group = (
        "CASE WHEN DeviceType IN ('desktop', 'mobile') THEN DeviceType"
        " WHEN hit IS NULL THEN 'no_identity_match' ELSE 'unknown_device' END"
    )
    hour = "CAST(floor((TransactionDT % 86400) / 3600) AS BIGINT)"
    dow = "CAST(floor((TransactionDT / 86400) % 7) AS BIGINT)"
    exotic = f"CASE WHEN id_31 IN ({', '.join(map(_text, R.EXOTIC_BROWSERS))}) THEN 1 ELSE 0 END"
    money = f"CAST({S.AMOUNT} AS DECIMAL(18,4))"  # exact here: the test tables have cents
    weights = "SELECT CAST(legit AS BIGINT) AS legit_count, CAST(fraud AS BIGINT) AS fraud_count, legit / fraud AS scale_pos_weight"
    simple = {name: _with(f"SELECT * FROM {name}", name) for name in (
        "stg_transaction", "stg_identity", "int_joined", "feat_time", "feat_velocity", "feat_final")}
    return {
        **simple,
        "load_files_by_header": _with(
            f"SELECT * REPLACE (CASE WHEN {S.KEY} % 2 = 1 THEN dist2 END AS dist2) FROM raw_transaction", "raw_transaction"),
        "layered_identity": _with("SELECT * FROM stg_identity", "stg_identity"),
        "stored_comparison": _with(
            f"SELECT position, model, round(roc_auc, 12) AS roc_auc, round(pr_auc, 10) AS pr_auc FROM ({_stored_compared()}) a",
            "stored_scores"),
        "stored_best": _with(
            f"SELECT position, model FROM ({_stored_compared()}) a ORDER BY roc_auc DESC, position LIMIT 1", "stored_scores"),
        "stored_predictions": _with(
            f"""SELECT {S.KEY}, round(score, 12) AS fraud_score, CAST(score >= 0.5 AS INTEGER) AS fraud_predicted,
  CASE WHEN score <= 0 THEN NULL WHEN score <= 0.3 THEN 'LOW' WHEN score <= 0.6 THEN 'MEDIUM' WHEN score <= 0.8 THEN 'HIGH'
    WHEN score <= 1 THEN 'CRITICAL' END AS risk_tier,
  {S.LABEL}, model AS model_used, is_exotic_browser, no_browser_os_signal, device_type, browser_family, os_version_group,
  device_manufacturer, p_email_group, txn_hour, txn_time_bucket, card1_txn_count_7d, amt_to_card_avg_ratio
FROM stored_scores WHERE position = 0""", "stored_scores"),
        "stored_attributions": _with(
            f"SELECT {S.KEY}, feature, round(contribution, 9) + 0.0 AS contribution FROM stump_parts", "stump_parts"),
        "stored_attribution_summary": _with(
            "SELECT feature, round(avg(abs(contribution)), 9) + 0.0 AS mean_abs_contribution FROM stump_parts GROUP BY feature",
            "stump_parts"),
        "load_normalized_transactions": _with("SELECT * FROM raw_transaction", "raw_transaction"),
        "load_row_counts": _with(
            "SELECT 'raw_transaction' AS table_name, count(*) AS n FROM raw_transaction"
            " UNION ALL SELECT 'raw_identity', count(*) FROM raw_identity",
            "raw_transaction", "raw_identity"),
        "column_catalog": _catalog(),
        "class_balance": _with(
            f"SELECT *, {_pct('transaction_count', '(sum(transaction_count) OVER ())')} AS percentage"
            f" FROM (SELECT {S.LABEL}, count(*) AS transaction_count FROM raw_transaction GROUP BY {S.LABEL}) c",
            "raw_transaction"),
        "fraud_rate_hour_dow": _with(
            _rates({"hour_of_day": hour, "day_of_week": dow}, "raw_transaction",
                   "ORDER BY fraud_rate_pct DESC, hour_of_day, day_of_week LIMIT 20"), "raw_transaction"),
        "amount_stats_by_class": _with(
            f"""SELECT {S.LABEL}, round(min({S.AMOUNT}), 2) AS min_amt,
  round(CAST(sum({money}) AS DOUBLE) / count({S.AMOUNT}), 2) AS avg_amt,
  CAST(round(CAST(median({S.AMOUNT}) AS DECIMAL(18,4)), 2) AS DOUBLE) AS median_amt,
  round(max({S.AMOUNT}), 2) AS max_amt, round(stddev_samp({S.AMOUNT}), 2) AS std_amt
FROM raw_transaction GROUP BY {S.LABEL}""", "raw_transaction"),
        "fraud_rate_email": _with(
            _rates({"P_emaildomain": "P_emaildomain"}, "(SELECT * FROM raw_transaction WHERE P_emaildomain IS NOT NULL) t",
                   "WHERE total > 500 ORDER BY fraud_rate_pct DESC, P_emaildomain LIMIT 20"), "raw_transaction"),
        "fraud_rate_device_type": _joined_rates(DeviceType="DeviceType"),
        "fraud_rate_os_version": _joined_rates(os_version_group=_case(R.EDA_OS_VERSION_RATE, "id_30")),
        "fraud_rate_manufacturer": _joined_rates(device_manufacturer=_case(R.EDA_MANUFACTURER_RATE, "DeviceInfo")),
        "fraud_rate_device_group": _joined_rates(device_group=device_group),
        "segment_dashboard": _joined_rates(
            os_family=_case(R.EDA_OS_FAMILY, "id_30"),
            browser_family=_case(R.DASHBOARD_BROWSER_FAMILY, "id_31"),
            device_manufacturer=_case(R.DASHBOARD_MANUFACTURER, "DeviceInfo"),
            DeviceType="DeviceType"),
        "eda_os_features": _features(
            ("os_family", _case(R.EDA_OS_FAMILY, "id_30")), ("os_version_group", _case(R.EDA_OS_VERSION, "id_30"))),
        "eda_browser_features": _features(
            ("browser_family", _case(R.EDA_BROWSER_FAMILY, "id_31")),
            ("chrome_version_bucket", _chrome("id_31", R.EDA_CHROME_BUCKETS)),
            ("is_exotic_browser", exotic)),
        "eda_device_features": _with(
            f"SELECT i.{S.KEY}, {_case(R.EDA_MANUFACTURER, 'i.DeviceInfo')} AS device_manufacturer,"
            f" {_case(R.EDA_SAMSUNG_TIER, 'i.DeviceInfo')} AS samsung_tier, t.{S.LABEL}"
            f" FROM raw_identity i LEFT JOIN raw_transaction t ON t.{S.KEY} = i.{S.KEY}",
            "raw_transaction", "raw_identity"),
        "null_counts": _null_counts(["dist1", "dist2", "addr1", "addr2"]),
        "feat_velocity_window": simple["feat_velocity"],
        "feat_velocity_strict": _with(_velocity("feat_time", strict=True), "feat_time"),
        "feat_velocity_orders": _rolling_orders(),
        "feat_final_with_v": _with(
            f"SELECT {', '.join(S.FEATURE_COLUMNS + [f'V{k}' for k in range(1, X.N_V + 1)])} FROM feat_velocity",
            "feat_velocity"),
        "dq_null_violations": _with(_violations("feat_final", S.REQUIRED), "feat_final"),
        "dq_null_violations_raw": _with(
            _violations("raw_transaction", ["card2", "addr1", "P_emaildomain"]), "raw_transaction"),
        "dq_duplicate_keys": _with(
            f"SELECT {S.KEY}, count(*) AS n FROM feat_final GROUP BY {S.KEY} HAVING count(*) > 1", "feat_final"),
        "dq_duplicate_keys_raw": _with(
            "SELECT card1, count(*) AS n FROM raw_transaction GROUP BY card1 HAVING count(*) > 1", "raw_transaction"),
        "dq_report": _report(),
        "dq_class_share": _with(
            f"SELECT *, {_pct('positives', 'n')} AS positive_pct FROM ("
            f"SELECT count(*) AS n, count(*) FILTER ({S.LABEL} = 1) AS positives FROM raw_transaction) c",
            "raw_transaction"),
        "kpi_overview": _with(
            f"SELECT *, {_pct('fraud_count', 'processed')} AS base_rate_pct FROM ("
            f"SELECT CAST(sum({money}) FILTER ({S.LABEL} = 1) AS DOUBLE) AS loss_exposure, count(*) AS processed,"
            f" count(*) FILTER ({S.LABEL} = 1) AS fraud_count FROM stg_transaction) k", "stg_transaction"),
        "kpi_hour": _kpi("txn_hour"),
        "kpi_email": _kpi("p_email_group"),
        "kpi_product": _kpi("ProductCD"),
        "kpi_browser": _kpi("browser_family"),
        "kpi_off_peak": _with(
            f"SELECT *, {_pct('off_peak', 'processed')} AS off_peak_pct FROM ("
            f"SELECT count(*) FILTER (txn_time_bucket = 'high_risk_hours') AS off_peak, count(*) AS processed"
            " FROM feat_time) k", "feat_time"),
        "ml_inputs": _with(
            f"SELECT {', '.join([S.KEY, S.LABEL, S.DAY, *S.NUMERIC, *S.CATEGORICAL])} FROM feat_velocity",
            "feat_velocity"),
        "sentinel_fill": _sentinel_fill(),
        "label_encode": _with(
            "SELECT " + S.KEY + ", " + ", ".join(
                f"CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS {c}_code" for c in S.CATEGORICAL
            ) + " FROM feat_time", "feat_time"),
        "time_split_summary": _with(
            f"SELECT part, count(*) AS n, CAST(sum({S.LABEL}) AS BIGINT) AS fraud_count,"
            f" avg({S.LABEL}) AS fraud_rate FROM parts GROUP BY part", "parts"),
        "label_mean": _with(
            f"SELECT count(*) AS n, CAST(sum({S.LABEL}) AS BIGINT) AS fraud_count, avg({S.LABEL}) AS fraud_rate"
            " FROM raw_transaction", "raw_transaction"),
        "class_weights": _with(
            f"{weights}, (legit + fraud) / (2 * legit) AS balanced_weight_legit,"
            " (legit + fraud) / (2 * fraud) AS balanced_weight_fraud FROM train_counts", "train_counts"),
        "validation_sample": _with(
            f"SELECT {S.KEY}, {S.LABEL}, {S.DAY} FROM parts WHERE part = 'validation'"
            f" ORDER BY md5(CAST({S.KEY} AS VARCHAR) || ':42'), {S.KEY} LIMIT 5000", "parts"),
        "pr_curve": _curve(
            "SELECT score AS threshold, tp / (tp + fp) AS precision, tp / p AS recall FROM curve"
            " UNION ALL SELECT NULL, 1.0, 0.0"),
        "average_precision": _curve(
            "SELECT round(sum(pos * (tp / (tp + fp))) / any_value(p), 10) AS average_precision FROM curve"),
        "roc_auc": _curve(
            "SELECT round(CAST(sum(pos * (2 * (n - fp) + neg)) AS DOUBLE) / (2 * any_value(p) * any_value(n)), 12)"
            " AS roc_auc FROM curve"),
        "score_histogram": _histogram(50),
        "confusion_at_half": _with(
            f"SELECT CAST(0.5 AS DOUBLE) AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,"
            f" CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall"
            f" FROM (SELECT {_counts_at('CAST(0.5 AS DOUBLE)')} FROM scores) c", "scores"),
        "threshold_costs": _with(_costs(GRID), "scores"),
        "threshold_costs_fine": _with(_costs(FINE_GRID), "scores"),
        "best_threshold": _with(
            f"SELECT * FROM ({_costs(FINE_GRID)}) f ORDER BY total_cost, threshold LIMIT 1", "scores"),
        "published_threshold_table": _with(_costs(GRID), "scores"),
        "risk_tiers": _with(
            f"SELECT {S.KEY}, {S.LABEL}, score, {S.AMOUNT}, CASE WHEN score >= CAST(0.5 AS DOUBLE) THEN 1 ELSE 0 END AS fraud_predicted,"
            f" {_TIER} AS risk_tier FROM scores", "scores"),
        "critical_queue": _with(
            f"SELECT *, {_pct('fraud_count', 'queue_size')} AS fraud_density_pct FROM ("
            f"SELECT count(*) AS queue_size, count(*) FILTER ({S.LABEL} = 1) AS fraud_count"
            f" FROM scores WHERE ({_TIER}) = 'CRITICAL') q", "scores"),
        "auto_block": _with(
            f"SELECT * FROM scores WHERE score >= CAST({BLOCK_SCORE} AS DOUBLE)", "scores"),
    }
