"""Feature step: per-card aggregates joined back, time/amount features
(A5, J2, F1-F13, A6).

The per-card statistics are a ``groupBy`` (partial + final hash aggregate)
followed by a left join, not a window over ``card1``: a window would send
every row of a hot card, and the whole wide row, to one task, whereas the
aggregate ships one partial row per card per map task, and the join back
spreads the rows of hot cards over several tasks (``operators.skew``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import half_away, money_avg, money_std, ratio
from ..functions.scalar import (is_large, is_night, is_weekend, log_amount, tx_day,
                                tx_day_of_week, tx_hour, zscore)
from ..schemas import AMOUNT, CARD, KEY, LABEL, NUMERIC_SENTINEL, TIME
from .skew import DEFAULT_HOT_ROWS, salted_left_join

CARD_AGG_COLUMNS = ["card1_tx_count", "card1_avg_amt", "card1_max_amt", "card1_std_amt",
                    "card1_fraud_count"]


def card_aggregates(cleaned: DataFrame, card: str = CARD, amount: str = AMOUNT,
                    label: str = LABEL, exclude=NUMERIC_SENTINEL) -> DataFrame:
    """Per card: count, average, max, sample std (2 dp) and fraud count (A5).

    Rows with the sentinel card are excluded; sentinel *amounts* are kept,
    so an average can be <= 0 (then the z-score below is -999).
    """
    return (cleaned.where(F.col(card) != F.lit(exclude))
            .groupBy(card)
            .agg(F.count(F.lit(1)).alias("card1_tx_count"),
                 money_avg(amount).alias("card1_avg_amt"),
                 half_away(F.max(amount), 2).alias("card1_max_amt"),
                 money_std(amount).alias("card1_std_amt"),
                 F.sum(label).cast("long").alias("card1_fraud_count")))


def row_features(cleaned: DataFrame, amount: str = AMOUNT, dt: str = TIME) -> DataFrame:
    """Cleaned rows + the seven features of the row itself (F1-F7): one
    projection, for consumers that need no per-card statistics."""
    hour, dow = tx_hour(dt), tx_day_of_week(dt)
    return cleaned.select(
        "*",
        hour.alias("tx_hour"), dow.alias("tx_day_of_week"), tx_day(dt).alias("tx_day"),
        is_night(hour).alias("is_night_tx"), is_weekend(dow).alias("is_weekend"),
        is_large(amount).alias("is_large_tx"), log_amount(amount).alias("log_TransactionAmt"),
    )


def engineer_features(cleaned: DataFrame, aggregates: DataFrame | None = None,
                      card: str = CARD, amount: str = AMOUNT, dt: str = TIME, key: str = KEY,
                      hot_rows: int = DEFAULT_HOT_ROWS) -> DataFrame:
    """Cleaned rows + 13 features.

    ``aggregates`` defaults to ``card_aggregates(cleaned)``.  Pass one
    computed from a narrower input to avoid evaluating the upstream join
    twice (see ``plans.etl.transform``).  The join back to the rows splits
    cards with more than ``hot_rows`` rows over several tasks
    (``operators.skew``); AQE still turns it into a broadcast when the
    aggregate is measured small.
    """
    agg = card_aggregates(cleaned, card, amount) if aggregates is None else aggregates
    # Row features first (one projection), then the join on card1.
    rows = row_features(cleaned, amount, dt)
    # The sentinel card is excluded from the statistics: its rows never
    # match and are spread too.
    joined = salted_left_join(rows, agg, card, "card1_tx_count", key, hot_rows,
                              never_match=[NUMERIC_SENTINEL])
    return joined.select(
        *[F.col(c) for c in rows.columns],
        F.coalesce(F.col("card1_tx_count"), F.lit(0).cast("long")).alias("card1_tx_count"),
        F.coalesce(F.col("card1_avg_amt"), F.lit(-999.0)).alias("card1_avg_amt"),
        F.coalesce(F.col("card1_max_amt"), F.lit(-999.0)).alias("card1_max_amt"),
        F.coalesce(F.col("card1_std_amt"), F.lit(-999.0)).alias("card1_std_amt"),
        F.coalesce(F.col("card1_fraud_count"), F.lit(0).cast("long")).alias("card1_fraud_count"),
        zscore(F.col(amount), F.col("card1_avg_amt"), F.col("card1_std_amt"))
        .alias("amt_deviation_from_card_mean"),
    )


def feature_summary(features: DataFrame) -> DataFrame:
    """Average hour (1 dp), night and weekend counts, average log amount (3 dp)."""
    return features.agg(
        ratio(F.sum("tx_hour"), F.count("tx_hour"), digits=1, scale=1.0).alias("avg_hour"),
        F.sum("is_night_tx").cast("long").alias("night_tx_count"),
        F.sum("is_weekend").cast("long").alias("weekend_count"),
        half_away(F.avg("log_TransactionAmt"), 3).alias("avg_log_amt"),
    )
