from __future__ import annotations

import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

from cardlens.schemas import C_COLS, D_COLS, M_COLS, TX_COLUMNS  # noqa: E402
from cardlens.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    ckpt = tempfile.mkdtemp(prefix="cardlens-test-ckpt-")
    s = build_session("local[4]", 8, extra={"spark.checkpoint.dir": ckpt,
                                            "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="cardlens-wh-")})
    yield s
    s.stop()


# Seven transactions and four identity rows: the unit fixture of the transform
# tests.  They cover a missing amount, card, product, address and e-mail, fractions
# of a cent, both borders of the night, a weekend and an identity row without a
# transaction.  Columns not listed take the filler values below.
BASE_ROWS = [
    # TransactionID, isFraud, TransactionDT, TransactionAmt, ProductCD, card1, card4, card6, addr1, P_emaildomain
    (11, 0, 10 * 3600 + 15, 12.345, "C", 70, "amex", "debit", 31.0, "outlook.com"),
    (12, 0, 23 * 3600, 151.005, "W", 70, "amex", "debit", 31.0, None),
    (13, 1, 5 * 86400 + 4 * 3600, 87.5, "H", 70, "amex", "debit", None, "gmail.com"),
    (14, 0, 2 * 86400 + 22 * 3600 - 1, None, "R", 81, "visa", "credit", 44.0, "yahoo.com"),
    (15, 1, 9 * 86400 + 6 * 3600, 3000.25, None, 81, "visa", "credit", 44.0, "gmail.com"),
    (16, 0, 6 * 86400, 0.004, "S", None, "discover", None, 7.0, "hotmail.com"),
    (17, 0, 13 * 86400 + 22 * 3600, 49.99, "W", 92, "mastercard", "credit", 58.0, "gmail.com"),
]
BASE_COLS = ["TransactionID", "isFraud", "TransactionDT", "TransactionAmt", "ProductCD", "card1",
             "card4", "card6", "addr1", "P_emaildomain"]


def tx_ddl() -> str:
    types = {"TransactionID": "BIGINT", "isFraud": "INT", "TransactionDT": "BIGINT", "card1": "BIGINT",
             "ProductCD": "STRING", "card4": "STRING", "card6": "STRING", "P_emaildomain": "STRING",
             "R_emaildomain": "STRING", "M4": "STRING"}
    for m in M_COLS:
        types.setdefault(m, "BOOLEAN")
    return ", ".join(f"{c} {types.get(c, 'DOUBLE')}" for c in TX_COLUMNS)


def make_tx(spark, rows, overrides: dict | None = None):
    """Rows of the 10 base columns, widened to the full transaction schema."""
    filler = {"card2": 3.0, "card3": None, "card5": 8.5, "addr2": None, "dist1": None, "dist2": 0.0}
    filler.update({c: float(k) for k, c in enumerate(C_COLS)})
    filler.update({c: None for c in D_COLS[1:]})
    filler.update(overrides or {})
    full = []
    for r in rows:
        d = dict(zip(BASE_COLS, r))
        full.append(tuple(d.get(c, filler.get(c)) for c in TX_COLUMNS))
    return spark.createDataFrame(full, tx_ddl())


def make_identity(spark, rows=None):
    rows = rows if rows is not None else [(12, "mobile", "iOS"), (15, "desktop", None), (17, None, "Windows"),
                                          (99, "desktop", "Linux")]
    return spark.createDataFrame(rows, "TransactionID BIGINT, DeviceType STRING, DeviceInfo STRING")


@pytest.fixture()
def raw_tx(spark):
    return make_tx(spark, BASE_ROWS)


@pytest.fixture()
def raw_identity(spark):
    return make_identity(spark)
