"""DuckDB SQL that recomputes each stage from the driver's base tables.

Used only to check the Spark results (the correctness oracle): it reads the
pre-registered views (``events`` ...), applies the same adapter rules and the
same rounding recipe as ``cardlens.functions.rounding``, and spells each
stage as a CTE.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from ..sources.adapter import (DUCKDB_TOKENS, IDENTITY_FILTER, IDENTITY_RULES, TX_RULES,
                               render)


# The oracle's own column lists, so that a wrong list of the
# library shows as a difference.
MATCHES = "M1 M2 M3 M4 M5 M6 M7 M8 M9".split()
COUNTS = "C1 C2 C3 C4 C5 C6 C7 C8 C9 C10 C11 C12 C13 C14".split()
DELTAS = "D1 D2 D3 D4 D5 D6 D7 D8 D9 D10 D11 D12 D13 D14 D15".split()
NUMERIC = ["TransactionAmt", "card1", "card2", "card3", "card5", "addr1", "addr2", "dist1", "dist2", *COUNTS, *DELTAS]
TEXT = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain", "id_DeviceType", "id_DeviceInfo"]
CLEAN = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1", "card2", "card3", "card4",
         "card5", "card6", "addr1", "addr2", "dist1", "dist2", "P_emaildomain", "R_emaildomain", *COUNTS, *DELTAS,
         *MATCHES, "has_identity", "id_DeviceType", "id_DeviceInfo"]
FEATURES = ["tx_hour", "tx_day_of_week", "tx_day", "is_night_tx", "is_weekend", "is_large_tx", "log_TransactionAmt",
            "card1_tx_count", "card1_avg_amt", "card1_max_amt", "card1_std_amt", "card1_fraud_count",
            "amt_deviation_from_card_mean"]
MODEL = ["TransactionAmt", "log_TransactionAmt", "card1", "card2", "card5", "addr1", "dist1", "C1", "C2", "C6", "C11",
         "D1", "D10", "D15", "tx_hour", "tx_day_of_week", "is_night_tx", "is_weekend", "is_large_tx", "has_identity",
         "card1_tx_count", "card1_avg_amt"]
QUALITY = ["TransactionID", "isFraud", "TransactionAmt", "ProductCD", "card1", "card4", "card6", "P_emaildomain",
           "has_identity", "tx_hour", "tx_day_of_week", "is_night_tx", "is_weekend", "is_large_tx", "log_TransactionAmt",
           "card1_tx_count", "card1_avg_amt"]
#: Columns of the staging view, by their names in the staging table.
VIEW = """TransactionID AS transaction_id, isFraud AS is_fraud, TransactionDT AS transaction_dt, tx_hour, tx_day_of_week,
  tx_day, is_night_tx, is_weekend, TransactionAmt AS transaction_amt, log_TransactionAmt AS log_transaction_amt,
  is_large_tx, ProductCD AS product_cd, card1, card4, card6, P_emaildomain AS payer_email_domain,
  R_emaildomain AS receiver_email_domain, addr1, addr2, has_identity, id_DeviceType AS device_type,
  id_DeviceInfo AS device_info, card1_tx_count, card1_avg_amt, card1_max_amt, card1_fraud_count,
  amt_deviation_from_card_mean"""


def _lit(v: float) -> str:
    return repr(float(v))


def half_away(x: str, digits: int) -> str:
    p = _lit(10 ** digits)
    return (f"(CASE WHEN ({x}) < 0 THEN -FLOOR(-({x}) * {p} + 0.5) / {p} "
            f"ELSE FLOOR(({x}) * {p} + 0.5) / {p} END + 0.0)")


def ratio(num: str, den: str, digits: int = 2, scale: float = 100.0) -> str:
    q = f"CAST({num} AS DOUBLE) * {_lit(scale * 10 ** digits)} / NULLIF(CAST({den} AS DOUBLE), 0.0)"
    return f"({half_away(q, 0)} / {_lit(10 ** digits)} + 0.0)"


def money_sum(x: str) -> str:
    """Plain decimal arithmetic: the sum is exact and rounded once."""
    return f"CAST(ROUND(SUM(CAST({x} AS DECIMAL(28, 6))), 2) AS DOUBLE)"


def money_avg(x: str) -> str:
    # whole cents by integer division, half away from zero: an exact quotient
    micros = f"CAST(SUM(CAST({x} AS DECIMAL(28, 6))) * 1000000 AS HUGEINT)"
    n = f"COUNT({x})"
    return (f"CASE WHEN {n} > 0 THEN SIGN({micros}) * CAST((ABS({micros}) + {n} * 5000) // ({n} * 10000) AS DOUBLE) "
            f"/ 100.0 END")


def money_std(x: str) -> str:
    """Sample deviation from exact sums of millionths and of their squares."""
    m = f"CAST(CAST({x} AS DECIMAL(28, 6)) * 1000000 AS HUGEINT)"
    spread = f"COUNT({x}) * SUM({m} * {m}) - SUM({m}) * SUM({m})"
    std = f"SQRT(CAST(CAST({spread} AS DECIMAL(38, 0)) AS DOUBLE) / (CAST(COUNT({x}) AS DOUBLE) * (COUNT({x}) - 1.0))) / 1000000.0"
    return f"CASE WHEN COUNT({x}) > 1 THEN {half_away(std, 2)} END"


def big(x: str) -> str:
    return f"CAST({x} AS BIGINT)"


def _clean_select() -> str:
    def filled(c: str) -> str:
        fill = "-999" if c in NUMERIC else "'unknown'" if c in TEXT else None
        return c if fill is None else f"COALESCE({c}, {fill}) AS {c}"
    return ", ".join(map(filled, CLEAN))


TX_CTE = "tx AS (SELECT " + ",\n  ".join(render(TX_RULES, DUCKDB_TOKENS)) + " FROM events)"
IDN_CTE = ("idn AS (SELECT " + ",\n  ".join(render(IDENTITY_RULES, DUCKDB_TOKENS))
           + f" FROM events WHERE {IDENTITY_FILTER})")
MERGED_CTE = """merged AS (
  SELECT t.*, i.id_01, i.DeviceType AS id_DeviceType, i.DeviceInfo AS id_DeviceInfo,
         CASE WHEN i.TransactionID IS NOT NULL THEN 1 ELSE 0 END AS has_identity
  FROM tx t LEFT JOIN idn i ON t.TransactionID = i.TransactionID)"""
CLEANED_CTE = f"cleaned AS (SELECT\n  {_clean_select()}\nFROM merged)"
CARD_AGG_CTE = f"""card_agg AS (
  SELECT card1,
         COUNT(*) AS card1_tx_count,
         {money_avg('TransactionAmt')} AS card1_avg_amt,
         {half_away('MAX(TransactionAmt)', 2)} AS card1_max_amt,
         {money_std('TransactionAmt')} AS card1_std_amt,
         {big('SUM(isFraud)')} AS card1_fraud_count
  FROM cleaned WHERE card1 <> -999 GROUP BY card1)"""
# Days and hours count from an unknown start: whole hours first, the rest from them.
STAGING_CTE = f"""staging AS (
  SELECT r.* EXCLUDE (whole_hour, whole_day),
    CAST(whole_hour % 24 AS INTEGER) AS tx_hour, CAST(whole_day % 7 AS INTEGER) AS tx_day_of_week,
    CAST(whole_day AS INTEGER) AS tx_day,
    CAST(whole_hour % 24 < 6 OR whole_hour % 24 > 21 AS INTEGER) AS is_night_tx,
    CAST(whole_day % 7 > 4 AS INTEGER) AS is_weekend,
    COALESCE(CAST(TransactionAmt > 150 AS INTEGER), 0) AS is_large_tx,
    CASE WHEN TransactionAmt > 0 THEN LN(1 + TransactionAmt) ELSE 0.0 END AS log_TransactionAmt,
    COALESCE(card1_tx_count, 0) AS card1_tx_count, COALESCE(card1_avg_amt, -999) AS card1_avg_amt,
    COALESCE(card1_max_amt, -999) AS card1_max_amt, COALESCE(card1_std_amt, -999) AS card1_std_amt,
    COALESCE(card1_fraud_count, 0) AS card1_fraud_count,
    CASE WHEN COALESCE(card1_avg_amt, 0) <= 0 THEN -999
         WHEN card1_std_amt <> 0 THEN {half_away('(TransactionAmt - card1_avg_amt) / card1_std_amt', 2)}
    END AS amt_deviation_from_card_mean
  FROM (SELECT *, TransactionDT // 3600 AS whole_hour, TransactionDT // 86400 AS whole_day FROM cleaned) r
  LEFT JOIN card_agg USING (card1))"""
STG_CTE = f"stg_fraud AS (SELECT {VIEW} FROM staging WHERE TransactionAmt <> -999)"

STAGES = {
    "tx": [TX_CTE],
    "idn": [IDN_CTE],
    "merged": [TX_CTE, IDN_CTE, MERGED_CTE],
    "cleaned": [TX_CTE, IDN_CTE, MERGED_CTE, CLEANED_CTE],
    "card_agg": [TX_CTE, IDN_CTE, MERGED_CTE, CLEANED_CTE, CARD_AGG_CTE],
    "staging": [TX_CTE, IDN_CTE, MERGED_CTE, CLEANED_CTE, CARD_AGG_CTE, STAGING_CTE],
    "stg_fraud": [TX_CTE, IDN_CTE, MERGED_CTE, CLEANED_CTE, CARD_AGG_CTE, STAGING_CTE, STG_CTE],
}


def with_stage(stage: str, body: str, extra: list[str] | None = None) -> str:
    """``WITH <ctes up to stage>[, extra...] <body>``."""
    ctes = STAGES[stage] + (extra or [])
    return "WITH " + ",\n".join(ctes) + "\n" + body


def round6(col: str, alias: str | None = None) -> str:
    return f"{half_away(col, 6)} AS {alias or col}"


@dataclass(frozen=True)
class Rule:
    """One expected report row: kind, column, arguments, severity."""

    kind: str
    column: str | None = None
    args: dict = field(default_factory=dict)
    severity: str = "error"


def _flag(c: str) -> Rule:
    return Rule("in_set", c, {"values": [0, 1]})


# The checks and tests that the reports must hold, in order.
SUITE = [
    Rule("row_count_between", None, {"min": 500_000, "max": 700_000}),
    Rule("columns_superset", None, {"columns": QUALITY}),
    _flag("isFraud"), Rule("not_null", "isFraud"), Rule("mean_between", "isFraud", {"min": 0.01, "max": 0.1}),
    Rule("not_null", "TransactionAmt"), Rule("not_null", "log_TransactionAmt"),
    Rule("between", "log_TransactionAmt", {"min": 0}),
    Rule("in_set", "ProductCD", {"values": ["W", "H", "C", "S", "R", "unknown"]}), Rule("not_null", "P_emaildomain"),
    Rule("between", "tx_hour", {"min": 0, "max": 23}), Rule("between", "tx_day_of_week", {"min": 0, "max": 6}),
    _flag("is_night_tx"), _flag("is_large_tx"), _flag("has_identity"), Rule("between", "card1_tx_count", {"min": 0}),
]
SOFT = [
    Rule("row_count_between", None, {"min": 500_000}, "warn"),
    Rule("mean_between", "isFraud", {"min": 0.03, "max": 0.04, "percent_digits": 2}, "warn"),
    Rule("not_in_set", "TransactionAmt", {"values": [-999]}, "warn"),
]
#: Reports by model: (name, table, tests).
MODELS = [
    ("staging_fraud", "staging", [
        Rule("unique", "TransactionID"), Rule("not_null", "TransactionID"), Rule("not_null", "isFraud"), _flag("isFraud"),
        Rule("not_null", "TransactionAmt"), Rule("not_null", "tx_hour"), _flag("has_identity")]),
    ("stg_fraud", "stg_fraud", [
        Rule("unique", "transaction_id"), Rule("not_null", "transaction_id"), Rule("not_null", "is_fraud"),
        _flag("is_fraud"), Rule("not_null", "tx_hour"), Rule("not_null", "transaction_amt")]),
    ("fraud_summary", "fraud_summary", [Rule("not_null", "card1"), Rule("not_null", "fraud_rate_pct")]),
    ("fraud_hourly", "fraud_hourly", [Rule("unique", "tx_hour"), Rule("not_null", "tx_hour")]),
]


def _q(v) -> str:
    return f"'{v}'" if isinstance(v, str) else repr(v)


def check_sql(i: int, chk: Rule, table: str) -> str:
    """One report row of ``operators.quality.run_checks`` in SQL."""
    a = chk.args
    col = "CAST(NULL AS VARCHAR)" if chk.column is None else f"'{chk.column}'"
    head = f"SELECT {i} AS check_id, '{chk.kind}' AS \"check\", {col} AS \"column\", "
    tail = f", '{chk.severity}' AS severity"
    c = chk.column
    if chk.kind == "columns_superset":
        missing = [x for x in a["columns"] if x not in CLEAN + FEATURES]
        return (head + f"CAST({len(a['columns'])} AS BIGINT) AS evaluated, "
                f"CAST({len(missing)} AS BIGINT) AS unexpected, CAST(NULL AS DOUBLE) AS observed, "
                f"{'TRUE' if not missing else 'FALSE'} AS success" + tail)
    if chk.kind == "row_count_between":
        conds = ["TRUE"]
        if a.get("min") is not None:
            conds.append(f"COUNT(*) >= {a['min']}")
        if a.get("max") is not None:
            conds.append(f"COUNT(*) <= {a['max']}")
        return (head + "COUNT(*) AS evaluated, CAST(NULL AS BIGINT) AS unexpected, "
                f"CAST(COUNT(*) AS DOUBLE) AS observed, ({' AND '.join(conds)}) AS success"
                + tail + f" FROM {table}")
    if chk.kind == "mean_between":
        mean, low, high = f"AVG({c})", a["min"], a["max"]
        if a.get("percent_digits") is not None:
            mean, low, high = half_away(f"AVG({c}) * 100.0", a["percent_digits"]), a["min"] * 100, a["max"] * 100
        return (head + f"COUNT({c}) AS evaluated, CAST(NULL AS BIGINT) AS unexpected, "
                f"{half_away(f'AVG({c})', 6)} AS observed, "
                f"COALESCE({mean} >= {low} AND {mean} <= {high}, FALSE) AS success"
                + tail + f" FROM {table}")
    if chk.kind == "unique":
        return (head + "CAST(COALESCE(SUM(n), 0) AS BIGINT) AS evaluated, "
                "CAST(COUNT_IF(n > 1) AS BIGINT) AS unexpected, CAST(NULL AS DOUBLE) AS observed, "
                "COUNT_IF(n > 1) = 0 AS success" + tail
                + f" FROM (SELECT {c}, COUNT(*) AS n FROM {table} WHERE {c} IS NOT NULL GROUP BY {c})")
    if chk.kind == "not_null":
        ev, bad = "COUNT(*)", f"COUNT_IF({c} IS NULL)"
    elif chk.kind == "in_set":
        ev, bad = f"COUNT({c})", f"COUNT_IF(NOT ({c} IN ({', '.join(_q(v) for v in a['values'])})))"
    elif chk.kind == "not_in_set":
        ev, bad = f"COUNT({c})", f"COUNT_IF({c} IN ({', '.join(_q(v) for v in a['values'])}))"
    elif chk.kind == "between":
        conds = []
        if a.get("min") is not None:
            conds.append(f"{c} {'<=' if a.get('strict_min') else '<'} {a['min']}")
        if a.get("max") is not None:
            conds.append(f"{c} {'>=' if a.get('strict_max') else '>'} {a['max']}")
        ev, bad = f"COUNT({c})", f"COUNT_IF({c} IS NOT NULL AND ({' OR '.join(conds) or 'FALSE'}))"
    else:
        raise ValueError(chk.kind)
    return (head + f"CAST({ev} AS BIGINT) AS evaluated, CAST({bad} AS BIGINT) AS unexpected, "
            f"CAST(NULL AS DOUBLE) AS observed, {bad} = 0 AS success" + tail + f" FROM {table}")


def checks_sql(checks: list[Rule], table: str, extra: str = "") -> str:
    """UNION ALL of the report rows of ``checks`` on ``table``."""
    parts = []
    for i, chk in enumerate(checks, start=1):
        body = check_sql(i, chk, table)
        parts.append(f"SELECT *{extra} FROM ({body})")
    return "\nUNION ALL\n".join(parts)
