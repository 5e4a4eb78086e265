"""Rows the six-row fixture lacks: NULL amount / card / time, singleton and
constant cards, boolean match columns, duplicate identity ids, no fraud."""

from __future__ import annotations

from pyspark.sql import functions as F

from cardlens.operators.marts import fraud_hourly, fraud_summary, stg_fraud
from cardlens.plans.etl import identity_ids_unique, transform
from tests.conftest import make_identity, make_tx

EDGE = [
    # id, fraud, dt, amount, product, card1, card4, card6, addr1, email
    (1, 0, 3600, None, "W", 2001, "visa", "credit", 1.0, "a.com"),     # NULL amount -> -999
    (2, 1, 7200, 40.0, "W", 2001, "visa", "credit", 1.0, "a.com"),
    (3, 0, 7300, 30.0, None, None, None, None, None, None),             # NULL card -> -999
    (4, 0, 50000, 12.5, "H", 3001, "amex", "debit", 2.0, "b.com"),      # singleton card
    (5, 0, 60000, 20.0, "C", 4001, "visa", "debit", 3.0, "c.com"),      # constant-amount card
    (6, 1, 61000, 20.0, "C", 4001, "visa", "debit", 3.0, "c.com"),
    (7, 0, None, 80.0, "R", 5001, "visa", "debit", 4.0, "d.com"),       # NULL time
]


def rows(df):
    return {r["TransactionID"]: r for r in df.collect()}


def test_sentinels_and_zscores(spark):
    f = rows(transform(make_tx(spark, EDGE), make_identity(spark, [])))
    # The sentinel amount enters the card statistics: mean (-999 + 40) / 2 < 0 -> -999
    assert f[1]["TransactionAmt"] == -999
    assert f[2]["card1_avg_amt"] == -479.5
    assert f[2]["amt_deviation_from_card_mean"] == -999
    # sentinel card: no statistics, z-score -999
    assert f[3]["card1"] == -999 and f[3]["card1_tx_count"] == 0 and f[3]["card1_avg_amt"] == -999
    assert f[3]["ProductCD"] == "unknown"
    assert f[3]["amt_deviation_from_card_mean"] == -999
    # Singleton card -> std NULL shown as -999, z-score NULL
    assert f[4]["card1_std_amt"] == -999 and f[4]["amt_deviation_from_card_mean"] is None
    # constant card -> std 0, z-score NULL
    assert f[5]["card1_std_amt"] == 0.0 and f[5]["amt_deviation_from_card_mean"] is None
    # NULL time -> NULL hour, flags 0
    assert f[7]["tx_hour"] is None and f[7]["is_night_tx"] == 0 and f[7]["is_weekend"] == 0
    # Sentinel amount -> log 0, not large
    assert f[1]["log_TransactionAmt"] == 0.0 and f[1]["is_large_tx"] == 0


def test_boolean_columns_keep_nulls(spark):
    tx = make_tx(spark, EDGE[:2], overrides={"M1": True})
    f = transform(tx, make_identity(spark, []))
    got = f.select("M1", "M2").collect()
    assert all(r["M1"] is True and r["M2"] is None for r in got)


def test_duplicate_identity_multiplies_rows(spark):
    tx = make_tx(spark, EDGE[:2])
    idn = make_identity(spark, [(2, "mobile", "iOS"), (2, "desktop", "Windows")])
    assert not identity_ids_unique(idn)
    f = transform(tx, idn)
    assert f.count() == 3
    # per-card statistics are taken over the merged rows
    assert rows(f.where("TransactionID = 1"))[1]["card1_tx_count"] == 3


def test_no_fraud_gives_null_shares(spark):
    no_fraud = [tuple(r[:1]) + (0,) + tuple(r[2:]) for r in EDGE if r[3] is not None and r[2] is not None]
    stg = stg_fraud(transform(make_tx(spark, no_fraud), make_identity(spark, [])))
    h = fraud_hourly(stg).collect()
    assert all(r["pct_of_daily_fraud"] is None for r in h)
    s = fraud_summary(stg, min_transactions=1).collect()
    assert all(r["fraud_night_pct"] is None for r in s)


def test_staging_drops_sentinel_amount_but_marts_keep_sentinel_card(spark):
    f = transform(make_tx(spark, EDGE), make_identity(spark, []))
    stg = stg_fraud(f)
    assert stg.where(F.col("transaction_id") == 1).count() == 0
    s = fraud_summary(stg, min_transactions=1)
    assert s.where("card1 = -999").count() == 1


def test_share_of_total_bounded_and_unbounded_agree(spark):
    from cardlens.operators.marts import share_of_total
    df = spark.createDataFrame([(i, i * 3) for i in range(50)], "g INT, n BIGINT")
    a = share_of_total(df, "n", "pct").orderBy("g").collect()
    b = share_of_total(df, "n", "pct", bounded=False).orderBy("g").collect()
    assert a == b and abs(sum(r["pct"] for r in a) - 100) < 0.5
