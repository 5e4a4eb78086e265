"""Staging model and fraud marts.

``stg_fraud`` stays a lazy view, so its filter and its 27-column projection
reach the Parquet scan of the staging table.  The marts are hash aggregates
(partial + final), so a hot card or hour is combined map-side before the
shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.rounding import money_avg, money_sum, half_away, ratio
from ..schemas import AMOUNT, NUMERIC_SENTINEL, STG_RENAMES


def rename_projection(df: DataFrame, renames=STG_RENAMES) -> DataFrame:
    """Select and rename in one projection."""
    return df.select(*[F.col(a).alias(b) for a, b in renames])


def has_value(column: str, sentinel=NUMERIC_SENTINEL) -> F.Column:
    return F.col(column) != F.lit(sentinel)


def drop_sentinel(df: DataFrame, column: str, sentinel=NUMERIC_SENTINEL) -> DataFrame:
    """``WHERE column != sentinel``; NULLs are dropped too."""
    return df.where(has_value(column, sentinel))


def stg_fraud(staging: DataFrame) -> DataFrame:
    """The staging model: 27 renamed columns, rows with a real amount."""
    return rename_projection(drop_sentinel(staging, AMOUNT))


def conditional_sum(cond, value) -> F.Column:
    """``SUM(CASE WHEN cond THEN value ELSE 0 END)``."""
    return F.sum(F.when(cond, value).otherwise(F.lit(0)))


def fraud_rate_pct(label: str = "is_fraud") -> F.Column:
    """``ROUND(AVG(label) * 100, 2)`` from integer sums."""
    return ratio(F.sum(label), F.count(label), digits=2)


def fraud_summary(stg: DataFrame, min_transactions: int = 5, ordered: bool = True) -> DataFrame:
    """Per (card1, card4, card6): 12 measures, groups of at least
    ``min_transactions`` rows (A8, A9, A12-A15), by fraud rate (O1).

    The ``card1 = -999`` group is kept.  ``ordered=False`` skips the global
    sort, which has no lasting meaning once the mart is stored as a table.
    """
    amt = F.col("transaction_amt")
    fraud = F.col("is_fraud") == 1
    out = (stg.groupBy("card1", "card4", "card6")
           .agg(F.count(F.lit(1)).alias("total_transactions"),
                F.sum("is_fraud").cast("long").alias("fraud_transactions"),
                fraud_rate_pct().alias("fraud_rate_pct"),
                half_away(F.min(amt), 2).alias("min_amount"),
                half_away(F.max(amt), 2).alias("max_amount"),
                money_avg(amt).alias("avg_amount"),
                money_sum(amt).alias("total_amount"),
                *flag_sums(["is_night_tx", "is_weekend", "is_large_tx", "has_identity"],
                           ["night_transactions", "weekend_transactions",
                            "large_transactions", "transactions_with_identity"]),
                ratio(conditional_sum(fraud & (F.col("is_night_tx") == 1), F.lit(1)),
                      F.sum("is_fraud"), digits=2).alias("fraud_night_pct"))
           .where(F.col("total_transactions") >= min_transactions)
           .withColumnRenamed("card4", "card_network")
           .withColumnRenamed("card6", "card_type"))
    if ordered:
        out = out.orderBy(F.desc_nulls_last("fraud_rate_pct"), "card1", "card_network", "card_type")
    return out


def flag_sums(flags: list[str], names: list[str]) -> list:
    """Sums of 0/1 flag columns as longs."""
    return [F.sum(f).cast("long").alias(n) for f, n in zip(flags, names)]


def share_of_total(df: DataFrame, column: str, alias: str, digits: int = 2,
                   bounded: bool = True) -> DataFrame:
    """``ROUND(x * 100.0 / SUM(x) OVER (), digits)`` over an aggregated frame.

    ``bounded=True``: the empty ``OVER ()`` gathers the frame in one
    partition, which is right for an aggregate with a bounded number of
    groups (``fraud_hourly`` has at most 24 x 2).  ``bounded=False``: the
    total is one global aggregate (partial sums per task) whose single value
    becomes a literal, so a frame of any size stays distributed.  NULL when
    the total is 0.
    """
    if bounded:
        total = F.sum(column).over(Window.partitionBy())
    else:
        total = F.lit(df.agg(F.sum(column)).first()[0])
    return df.withColumn(alias, ratio(F.col(column), total, digits=digits))


def fraud_hourly(stg: DataFrame, ordered: bool = True) -> DataFrame:
    """Per (tx_hour, is_night_tx): volume, fraud, amounts and shares."""
    amt = F.col("transaction_amt")
    agg = (stg.groupBy("tx_hour", "is_night_tx")
           .agg(F.count(F.lit(1)).alias("total_transactions"),
                F.sum("is_fraud").cast("long").alias("fraud_transactions"),
                fraud_rate_pct().alias("fraud_rate_pct"),
                money_avg(amt).alias("avg_amount"),
                money_sum(F.when(F.col("is_fraud") == 1, amt).otherwise(F.lit(0.0)))
                .alias("fraud_total_amount")))
    out = share_of_total(agg, "total_transactions", "pct_of_daily_volume")
    out = share_of_total(out, "fraud_transactions", "pct_of_daily_fraud")
    if ordered:
        out = out.orderBy("tx_hour", "is_night_tx")
    return out


def top_k(df: DataFrame, column: str, k: int, descending: bool = True) -> DataFrame:
    """First ``k`` rows by ``column``, ties in order of the other columns
    (``TakeOrderedAndProject``: a bounded heap per task, no full sort)."""
    order = F.desc_nulls_last(column) if descending else F.asc_nulls_last(column)
    return df.orderBy(order, *[c for c in df.columns if c != column]).limit(k)
