"""Column lists and schemas of the transaction tables.

The names below are fixed values: they must equal the column names of the
transaction / identity data model so that downstream marts, checks and the
model see the same columns.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Column names of the data model, in table order.
# ---------------------------------------------------------------------------
KEY = "TransactionID"
LABEL = "isFraud"
TIME = "TransactionDT"
AMOUNT = "TransactionAmt"
CARD = "card1"

C_COLS = [f"C{i}" for i in range(1, 15)]
D_COLS = [f"D{i}" for i in range(1, 16)]
M_BOOL_COLS = ["M1", "M2", "M3", "M5", "M6", "M7", "M8", "M9"]
M_COLS = ["M1", "M2", "M3", "M4", "M5", "M6", "M7", "M8", "M9"]

# Raw transaction columns, in file order.
TX_COLUMNS = ([KEY, LABEL, TIME, AMOUNT, "ProductCD",
               "card1", "card2", "card3", "card4", "card5", "card6",
               "addr1", "addr2", "dist1", "dist2",
               "P_emaildomain", "R_emaildomain"] + C_COLS + D_COLS + M_COLS)

# Identity columns that get the ``id_`` prefix when merged.
DEVICE_COLS = ["DeviceType", "DeviceInfo"]

# Cleaning: numeric columns filled with -999 (38), string columns filled with
# 'unknown' (7), columns passed through unchanged (13).
NUMERIC_FILL = ([AMOUNT, "card1", "card2", "card3", "card5", "addr1", "addr2",
                 "dist1", "dist2"] + C_COLS + D_COLS)
STRING_FILL = ["ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain",
               "id_DeviceType", "id_DeviceInfo"]
PASSTHROUGH = [KEY, LABEL, TIME] + M_COLS + ["has_identity"]

NUMERIC_SENTINEL = -999
STRING_SENTINEL = "unknown"

# Column order of the cleaned table (58 columns).
CLEAN_COLUMNS = ([KEY, LABEL, TIME, AMOUNT, "ProductCD",
                  "card1", "card2", "card3", "card4", "card5", "card6",
                  "addr1", "addr2", "dist1", "dist2",
                  "P_emaildomain", "R_emaildomain"] + C_COLS + D_COLS + M_COLS
                 + ["has_identity", "id_DeviceType", "id_DeviceInfo"])

# The 13 engineered features appended to the cleaned columns (71 in total).
FEATURE_COLUMNS = ["tx_hour", "tx_day_of_week", "tx_day", "is_night_tx", "is_weekend",
                   "is_large_tx", "log_TransactionAmt", "card1_tx_count", "card1_avg_amt",
                   "card1_max_amt", "card1_std_amt", "card1_fraud_count",
                   "amt_deviation_from_card_mean"]
STAGING_COLUMNS = CLEAN_COLUMNS + FEATURE_COLUMNS

# Model inputs (22 columns).
MODEL_FEATURES = [
    "TransactionAmt", "log_TransactionAmt", "card1", "card2", "card5", "addr1", "dist1",
    "C1", "C2", "C6", "C11", "D1", "D10", "D15",
    "tx_hour", "tx_day_of_week", "is_night_tx", "is_weekend", "is_large_tx",
    "has_identity", "card1_tx_count", "card1_avg_amt",
]

# Staging model, source column -> published name (27 columns, in order).
STG_RENAMES = [
    ("TransactionID", "transaction_id"), ("isFraud", "is_fraud"),
    ("TransactionDT", "transaction_dt"), ("tx_hour", "tx_hour"),
    ("tx_day_of_week", "tx_day_of_week"), ("tx_day", "tx_day"),
    ("is_night_tx", "is_night_tx"), ("is_weekend", "is_weekend"),
    ("TransactionAmt", "transaction_amt"), ("log_TransactionAmt", "log_transaction_amt"),
    ("is_large_tx", "is_large_tx"), ("ProductCD", "product_cd"), ("card1", "card1"),
    ("card4", "card4"), ("card6", "card6"), ("P_emaildomain", "payer_email_domain"),
    ("R_emaildomain", "receiver_email_domain"), ("addr1", "addr1"), ("addr2", "addr2"),
    ("has_identity", "has_identity"), ("id_DeviceType", "device_type"),
    ("id_DeviceInfo", "device_info"), ("card1_tx_count", "card1_tx_count"),
    ("card1_avg_amt", "card1_avg_amt"), ("card1_max_amt", "card1_max_amt"),
    ("card1_fraud_count", "card1_fraud_count"),
    ("amt_deviation_from_card_mean", "amt_deviation_from_card_mean"),
]

# Columns read by the data-quality stage (17).
QUALITY_COLUMNS = [
    "TransactionID", "isFraud", "TransactionAmt", "ProductCD", "card1", "card4", "card6",
    "P_emaildomain", "has_identity", "tx_hour", "tx_day_of_week", "is_night_tx",
    "is_weekend", "is_large_tx", "log_TransactionAmt", "card1_tx_count", "card1_avg_amt",
]

# Known product codes.
PRODUCT_CODES = ["W", "H", "C", "S", "R", "unknown"]

# ---------------------------------------------------------------------------
# Raw schemas for file sources.  The boolean M columns are read as text and
# converted with try_cast afterwards, so that 'T'/'F' and 'true'/'false' both
# work and other text becomes NULL instead of marking the whole row corrupt.
# ---------------------------------------------------------------------------
_STRING_TX = {"ProductCD", "card4", "card6", "P_emaildomain", "R_emaildomain"} | set(M_COLS)
_LONG_TX = {KEY, TIME, "card1"}
_INT_TX = {LABEL}


def _tx_field(name: str) -> T.StructField:
    if name in _STRING_TX:
        return T.StructField(name, T.StringType(), True)
    if name in _LONG_TX:
        return T.StructField(name, T.LongType(), True)
    if name in _INT_TX:
        return T.StructField(name, T.IntegerType(), True)
    return T.StructField(name, T.DoubleType(), True)


RAW_TRANSACTION_SCHEMA = T.StructType([_tx_field(c) for c in TX_COLUMNS])

RAW_IDENTITY_SCHEMA = T.StructType([
    T.StructField(KEY, T.LongType(), True),
    T.StructField("id_01", T.DoubleType(), True),
    T.StructField("DeviceType", T.StringType(), True),
    T.StructField("DeviceInfo", T.StringType(), True),
])

CORRUPT_COLUMN = "_corrupt_record"


def with_corrupt_column(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(CORRUPT_COLUMN, T.StringType(), True)])


# Typed transaction schema of ingested (Parquet) tables: flags are BOOLEAN.
TRANSACTION_SCHEMA = T.StructType([
    T.StructField(f.name, T.BooleanType(), True) if f.name in M_BOOL_COLS else f
    for f in RAW_TRANSACTION_SCHEMA.fields
])
