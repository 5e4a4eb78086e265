"""Adapter: the driver's ``events`` table read as card transactions + identity.

The test tables carry no card data, so each transaction column is derived
from an ``events`` row by a fixed rule (see FIXTURES.md section 3).  Rules
are kept once, as SQL expressions with three dialect tokens, and rendered
for Spark (``selectExpr``) and for the DuckDB oracle, so both engines read
the very same input.  Everything is a projection / filter of one scan: no
shuffle, and the work grows with ``events``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import C_COLS, D_COLS

# Dialect tokens: {k} = integer k of the props JSON, {dt} = seconds since the
# base date of the stream.
SPARK_TOKENS = {
    "k": "CAST(get_json_object(props, '$.k') AS INT)",
    "dt": "timestampdiff(SECOND, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)",
}
DUCKDB_TOKENS = {
    "k": "CAST(props->>'$.k' AS INTEGER)",
    "dt": "date_diff('second', TIMESTAMP '2024-01-01 00:00:00', ts)",
}


def _pick(key: str, options: list[str]) -> str:
    whens = " ".join(f"WHEN {key} % {len(options)} = {i} THEN '{v}'"
                     for i, v in enumerate(options[:-1]))
    return f"{whens} ELSE '{options[-1]}'"


# Category labels used by the rules.
_NETWORKS = ["visa", "mastercard", "amex", "discover"]
_DOMAINS = ["gmail.com", "yahoo.com", "hotmail.com", "anonymous.com", "outlook.com"]

# Transaction rules, in column order of the raw transaction table.
TX_RULES: list[tuple[str, str]] = [
    ("TransactionID", "event_id"),
    ("isFraud", "CASE WHEN {k} < 4 THEN 1 ELSE 0 END"),
    ("TransactionDT", "{dt}"),
    ("TransactionAmt", "CASE WHEN event_id % 97 = 0 THEN NULL "
                       "ELSE value + (event_id % 10) / 1000.0 END"),  # fractions of a cent
    ("ProductCD", "CASE WHEN event_id % 89 = 0 THEN NULL WHEN event_type = 'purchase' THEN 'W' "
                  "WHEN event_type = 'view' THEN 'H' WHEN event_type = 'click' THEN 'C' "
                  "WHEN event_type = 'signup' THEN 'S' ELSE 'R' END"),
    ("card1", "CASE WHEN event_id % 41 = 0 THEN NULL WHEN event_id % 1000 = 1 "
              "THEN 1000000 + event_id ELSE user_id END"),
    ("card2", "CASE WHEN user_id % 7 = 0 THEN NULL ELSE CAST(100 + user_id % 500 AS DOUBLE) END"),
    ("card3", "CASE WHEN event_id % 53 = 0 THEN NULL ELSE CAST(150 + user_id % 3 AS DOUBLE) END"),
    ("card4", f"CASE WHEN user_id % 11 = 0 THEN NULL {_pick('user_id', _NETWORKS)} END"),
    ("card5", "CASE WHEN user_id % 17 = 0 THEN NULL ELSE CAST(100 + user_id % 126 AS DOUBLE) END"),
    ("card6", "CASE WHEN user_id % 13 = 0 THEN NULL WHEN user_id % 2 = 0 THEN 'credit' "
              "ELSE 'debit' END"),
    ("addr1", "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(100 + user_id % 400 AS DOUBLE) END"),
    ("addr2", "CASE WHEN event_id % 9 = 0 THEN NULL ELSE CAST(60 + user_id % 40 AS DOUBLE) END"),
    ("dist1", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CAST({k} AS DOUBLE) END"),
    ("dist2", "CASE WHEN event_id % 5 = 0 THEN CAST({k} * 3 AS DOUBLE) ELSE NULL END"),
    ("P_emaildomain", f"CASE WHEN event_id % 13 = 0 THEN NULL {_pick('user_id', _DOMAINS)} END"),
    ("R_emaildomain", f"CASE WHEN event_id % 2 = 0 THEN NULL "
                      f"{_pick('(user_id + event_id)', _DOMAINS)} END"),
]
TX_RULES += [
    (c, f"CASE WHEN (event_id + {n}) % {n + 20} = 0 THEN NULL "
        f"ELSE CAST((event_id * {n} + {{k}}) % {n + 3} AS DOUBLE) END")
    for n, c in enumerate(C_COLS, start=1)
]
TX_RULES += [
    (c, f"CASE WHEN (event_id + {n}) % {n + 2} = 0 THEN NULL "
        f"ELSE CAST((user_id * {n} + {{k}}) % {10 * n + 5} AS DOUBLE) END")
    for n, c in enumerate(D_COLS, start=1)
]
TX_RULES += [
    (f"M{n}", f"CASE WHEN (event_id + {n}) % 3 = 0 THEN NULL ELSE (event_id + {n}) % 2 = 0 END")
    if n != 4 else
    ("M4", "CASE WHEN event_id % 3 = 0 THEN NULL ELSE CONCAT('M', CAST(event_id % 3 AS STRING)) END")
    for n in range(1, 10)
]

# Identity rules: one identity row for every fourth event.
IDENTITY_FILTER = "event_id % 4 = 0"
IDENTITY_RULES: list[tuple[str, str]] = [
    ("TransactionID", "event_id"),
    ("id_01", "CAST(-(event_id % 50) AS DOUBLE)"),
    ("DeviceType", "CASE WHEN event_id % 8 = 0 THEN 'mobile' ELSE 'desktop' END"),
    ("DeviceInfo", "CASE WHEN event_id % 3 = 0 THEN 'Windows' WHEN event_id % 3 = 1 "
                   "THEN 'iOS' ELSE NULL END"),
]


def render(rules: list[tuple[str, str]], tokens: dict) -> list[str]:
    return [f"{expr.format(**tokens)} AS {name}" for name, expr in rules]


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def transactions_from_events(events: DataFrame) -> DataFrame:
    # The JSON value feeds many rules: parse it once per row (an aliased
    # column that the optimizer keeps instead of re-parsing per use).
    tokens = dict(SPARK_TOKENS, k="__k")
    return (events.withColumn("__k", F.expr(SPARK_TOKENS["k"]))
            .selectExpr(*render(TX_RULES, tokens)))


def identity_from_events(events: DataFrame) -> DataFrame:
    return events.where(IDENTITY_FILTER).selectExpr(*render(IDENTITY_RULES, SPARK_TOKENS))


def load_sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(transactions, identity) derived from ``{sf_dir}/events.parquet``."""
    events = read_events(spark, sf_dir)
    return transactions_from_events(events), identity_from_events(events)
