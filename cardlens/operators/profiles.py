"""One-pass profiles of a table.

Each profile is a single global aggregate: partial aggregates per task and
one tiny final merge, whatever the size of the table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import money_avg, half_away, ratio
from ..schemas import AMOUNT, CARD, KEY, LABEL, NUMERIC_SENTINEL


def distinct_count(column: str, exact: bool = True, rsd: float = 0.01):
    """Exact ``COUNT(DISTINCT c)`` or a HyperLogLog++ estimate."""
    return F.count_distinct(F.col(column)) if exact else F.approx_count_distinct(column, rsd)


def transaction_summary(tx: DataFrame, key: str = KEY, amount: str = AMOUNT,
                        label: str = LABEL, exact_distinct: bool = True) -> DataFrame:
    """Rows, distinct ids, min/max/avg amount (2 dp), fraud count and rate,
    missing amounts (A1)."""
    return tx.agg(
        F.count(F.lit(1)).alias("total_rows"),
        distinct_count(key, exact_distinct).alias("unique_tx"),
        half_away(F.min(amount), 2).alias("min_amount"),
        half_away(F.max(amount), 2).alias("max_amount"),
        money_avg(amount).alias("avg_amount"),
        F.sum(label).cast("long").alias("fraud_count"),
        ratio(F.sum(label), F.count(label)).alias("fraud_rate_pct"),
        (F.count(F.lit(1)) - F.count(amount)).alias("missing_amounts"),
    )


def identity_summary(identity: DataFrame, key: str = KEY, exact_distinct: bool = True) -> DataFrame:
    """Rows and distinct ids of the identity table (A2)."""
    return identity.agg(F.count(F.lit(1)).alias("total_rows"),
                        distinct_count(key, exact_distinct).alias("unique_tx"))


def load_readback(table: DataFrame, amount: str = AMOUNT, label: str = LABEL,
                  card: str = CARD, exact_distinct: bool = True) -> DataFrame:
    """Read-back profile of a loaded table."""
    return table.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(label).cast("long").alias("fraud_count"),
        ratio(F.sum(label), F.count(label)).alias("fraud_rate_pct"),
        half_away(F.min(amount), 2).alias("min_amount"),
        half_away(F.max(amount), 2).alias("max_amount"),
        money_avg(amount).alias("avg_amount"),
        F.count_if(F.col(amount) == F.lit(NUMERIC_SENTINEL)).alias("missing_amounts"),
        distinct_count(card, exact_distinct).alias("unique_cards"),
    )


def rate_by_division(df: DataFrame, label: str, amount: str) -> DataFrame:
    """Count, label sum, average amount (2 dp), ``ROUND(SUM(y)*100.0/COUNT(*), 1)``."""
    return df.agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(label).cast("long").alias("fraud_count"),
        money_avg(amount).alias("avg_amount"),
        ratio(F.sum(label), F.count(F.lit(1)), digits=1).alias("fraud_rate_pct"),
    )


def min_max(df: DataFrame, column: str) -> DataFrame:
    """``MIN(c), MAX(c)``."""
    return df.agg(F.min(column).alias(f"min_{column}"), F.max(column).alias(f"max_{column}"))


def sum_of_complement(df: DataFrame, flag: str) -> DataFrame:
    """``SUM(flag), SUM(1 - flag)``."""
    return df.agg(F.sum(flag).cast("long").alias(f"{flag}_ones"),
                  F.sum(F.lit(1) - F.col(flag)).cast("long").alias(f"{flag}_zeros"))


def class_prior(df: DataFrame, label: str = LABEL, by: str | None = None) -> DataFrame:
    """Mean of the label (4 dp), overall or per ``by`` group."""
    measure = ratio(F.sum(label), F.count(label), digits=4, scale=1.0).alias("label_mean")
    return df.groupBy(by).agg(measure) if by else df.agg(measure)
