"""Merge, clean and feature steps on the seven-row fixture."""

from __future__ import annotations

import statistics

from pyspark.sql import functions as F

from cardlens.operators.clean import clean, missing_profile
from cardlens.operators.features import card_aggregates, engineer_features, feature_summary
from cardlens.operators.merge import identity_columns, join_coverage, merge_identity
from cardlens.plans.etl import transform
from cardlens.schemas import CLEAN_COLUMNS, STAGING_COLUMNS


def by_id(df):
    return {r["TransactionID"]: r for r in df.collect()}


# --- merge ------------------------------------------------------------------

def test_merge_keeps_every_transaction(raw_tx, raw_identity):
    assert merge_identity(raw_tx, raw_identity).count() == 7


def test_merge_flags_three_with_identity(raw_tx, raw_identity):
    m = merge_identity(raw_tx, raw_identity)
    got = m.agg(F.sum("has_identity").alias("y"), F.sum(1 - F.col("has_identity")).alias("n")).first()
    assert (got["y"], got["n"]) == (3, 4)


def test_merge_device_joined_and_null_for_unmatched(raw_tx, raw_identity):
    rows = by_id(merge_identity(raw_tx, raw_identity))
    assert rows[12]["id_DeviceType"] == "mobile"
    assert rows[17]["id_DeviceType"] is None and rows[17]["has_identity"] == 1   # matched, but NULL
    assert rows[14]["id_DeviceType"] is None and rows[14]["has_identity"] == 0


def test_merge_columns_are_dynamic(raw_tx, raw_identity):
    assert identity_columns(raw_identity) == ["DeviceType", "DeviceInfo"]
    m = merge_identity(raw_tx, raw_identity)
    assert m.columns[-3:] == ["id_DeviceType", "id_DeviceInfo", "has_identity"]


def test_join_coverage(raw_tx, raw_identity):
    r = join_coverage(merge_identity(raw_tx, raw_identity)).first()
    assert (r["total_rows"], r["with_identity"], r["with_identity_pct"], r["without_identity"]) == (7, 3, 42.9, 4)


# --- clean ------------------------------------------------------------------

def cleaned(raw_tx, raw_identity):
    return clean(merge_identity(raw_tx, raw_identity))


def test_clean_fills_email(raw_tx, raw_identity):
    assert by_id(cleaned(raw_tx, raw_identity))[12]["P_emaildomain"] == "unknown"


def test_clean_fills_addr(raw_tx, raw_identity):
    assert by_id(cleaned(raw_tx, raw_identity))[13]["addr1"] == -999


def test_clean_keeps_values(raw_tx, raw_identity):
    assert by_id(cleaned(raw_tx, raw_identity))[11]["P_emaildomain"] == "outlook.com"


def test_clean_row_count_and_columns(raw_tx, raw_identity):
    c = cleaned(raw_tx, raw_identity)
    assert c.count() == 7
    assert c.columns == CLEAN_COLUMNS and len(CLEAN_COLUMNS) == 58


def test_clean_requires_all_columns(raw_tx, raw_identity):
    import pytest
    with pytest.raises(ValueError):
        clean(merge_identity(raw_tx.drop("D15"), raw_identity))


def test_missing_profile(raw_tx, raw_identity):
    r = missing_profile(merge_identity(raw_tx, raw_identity), ["addr1", "P_emaildomain", "card1"]).first()
    assert (r["missing_addr1"], r["missing_P_emaildomain"], r["missing_card1"]) == (1, 1, 1)


# --- features -----------------------------------------------------------------

def features(raw_tx, raw_identity):
    return transform(raw_tx, raw_identity)


def test_hour_in_range(raw_tx, raw_identity):
    f = features(raw_tx, raw_identity)
    r = f.agg(F.min("tx_hour").alias("lo"), F.max("tx_hour").alias("hi")).first()
    assert 0 <= r["lo"] and r["hi"] <= 23


def test_night_flag(raw_tx, raw_identity):
    rows = by_id(features(raw_tx, raw_identity))
    # 22:00 to 05:59 is night: hours 10, 23, 4, 21, 6, 0, 22
    assert [rows[i]["is_night_tx"] for i in range(11, 18)] == [0, 1, 1, 0, 0, 1, 1]
    assert [rows[i]["is_weekend"] for i in range(11, 18)] == [0, 0, 1, 0, 0, 1, 1]


def test_log_amount_positive(raw_tx, raw_identity):
    f = features(raw_tx, raw_identity).where("TransactionAmt > 0")
    assert f.where("log_TransactionAmt <= 0").count() == 0


def test_card_count(raw_tx, raw_identity):
    assert by_id(features(raw_tx, raw_identity))[11]["card1_tx_count"] == 3


def test_large_flag(raw_tx, raw_identity):
    rows = by_id(features(raw_tx, raw_identity))
    assert rows[12]["is_large_tx"] == 1 and rows[13]["is_large_tx"] == 0


def test_feature_row_count_and_columns(raw_tx, raw_identity):
    f = features(raw_tx, raw_identity)
    assert f.count() == 7
    assert f.columns == STAGING_COLUMNS and len(STAGING_COLUMNS) == 71


def test_card_statistics_values(raw_tx, raw_identity):
    rows = by_id(features(raw_tx, raw_identity))
    # card 70: 12.345 + 151.005 + 87.5 = 250.85; the mean keeps fractions of a cent
    amounts = [12.345, 151.005, 87.5]
    assert rows[11]["card1_avg_amt"] == 83.62
    assert rows[11]["card1_std_amt"] == round(statistics.stdev(amounts), 2)
    assert rows[11]["card1_fraud_count"] == 1
    # z-score uses the rounded mean and std
    assert rows[11]["amt_deviation_from_card_mean"] == round((12.345 - 83.62) / rows[11]["card1_std_amt"], 2)
    # card 81: the missing amount counts as -999
    assert (rows[14]["card1_avg_amt"], rows[14]["card1_max_amt"]) == (1000.63, 3000.25)
    # no card: no statistics
    assert (rows[16]["card1"], rows[16]["card1_tx_count"], rows[16]["amt_deviation_from_card_mean"]) == (-999, 0, -999.0)


def test_feature_summary(raw_tx, raw_identity):
    r = feature_summary(features(raw_tx, raw_identity)).first()
    # hours 10, 23, 4, 21, 6, 0, 22 -> mean 12.29
    assert (r["avg_hour"], r["night_tx_count"], r["weekend_count"]) == (12.3, 4, 3)


def test_prejoin_and_postjoin_statistics_agree(raw_tx, raw_identity):
    post = engineer_features(cleaned(raw_tx, raw_identity))
    pre = transform(raw_tx, raw_identity, identity_unique=True)
    cols = ["TransactionID", "card1_tx_count", "card1_avg_amt", "card1_std_amt", "amt_deviation_from_card_mean"]
    assert sorted(post.select(cols).collect()) == sorted(pre.select(cols).collect())


def test_card_aggregates_exclude_sentinel_card(spark, raw_identity):
    from tests.conftest import BASE_ROWS, make_tx
    c = clean(merge_identity(make_tx(spark, BASE_ROWS), raw_identity))
    assert sorted(r["card1"] for r in card_aggregates(c).collect()) == [70, 81, 92]


def test_missing_ids_can_be_spread(spark, raw_identity):
    from tests.conftest import BASE_ROWS, make_tx
    tx = make_tx(spark, BASE_ROWS + [(None, 0, 5, 1.0, "W", k, "visa", "credit", 1.0, "x.com") for k in range(9)])
    plain, spread = (merge_identity(tx, raw_identity, null_keys_by=c) for c in (None, "card1"))
    assert plain.columns == spread.columns
    assert sorted(plain.collect(), key=str) == sorted(spread.collect(), key=str)


def test_wide_rows_are_compiled(spark):
    from cardlens.plans.stages import stages
    from cardlens.session import HUGE_METHOD, HUGE_METHOD_BYTES
    spark.conf.set(HUGE_METHOD, "65535")  # Spark's default, as in a session built elsewhere
    stages(spark, "/root/testdata/sf0.001")
    assert int(spark.conf.get(HUGE_METHOD)) == HUGE_METHOD_BYTES
    spark.conf.set(HUGE_METHOD, "4000")  # a lower limit is left
    stages(spark, "/root/testdata/sf0.001")
    assert spark.conf.get(HUGE_METHOD) == "4000"
    spark.conf.set(HUGE_METHOD, str(HUGE_METHOD_BYTES))
