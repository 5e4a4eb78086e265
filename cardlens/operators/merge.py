"""Merge step: transactions LEFT JOIN identity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import ratio
from ..schemas import DEVICE_COLS, KEY

_MATCH = "__identity_match"
_SPREAD = "__spread"


def identity_columns(identity: DataFrame, key: str = KEY) -> list[str]:
    """Identity columns in table order, without the join key.

    The comparison is case-sensitive, like the catalog query it replaces.
    """
    return [c for c in identity.columns if c != key]


def identity_projection(identity: DataFrame, key: str = KEY,
                        prefixed: tuple[str, ...] | list[str] = tuple(DEVICE_COLS)) -> DataFrame:
    """Identity columns renamed for the merge (``DeviceType`` -> ``id_DeviceType``)
    plus a constant match marker that survives the outer join (P1, P2)."""
    cols = [F.col(c).alias(f"id_{c}" if c in prefixed else c) for c in identity_columns(identity, key)]
    return identity.select(F.col(key), *cols, F.lit(1).alias(_MATCH))


def merge_identity(transactions: DataFrame, identity: DataFrame, key: str = KEY,
                   prefixed: tuple[str, ...] | list[str] = tuple(DEVICE_COLS),
                   null_keys_by: str | None = None) -> DataFrame:
    """Every transaction, with the identity columns of its match.

    ``has_identity`` is 1 when a match exists, from a marker column added to
    the identity side before the outer join, so a NULL-valued identity row
    still counts as a match.  Join strategy is left to the optimizer: a
    broadcast when the identity side is measured below the broadcast
    threshold, otherwise a sort-merge join whose skewed partitions AQE splits.
    Duplicate identity ids multiply transaction rows, as in a SQL left join.
    Transactions without an id match nothing; if there may be many of them,
    ``null_keys_by`` names a column whose hash spreads them over the tasks.
    """
    right = identity_projection(identity, key, prefixed)
    right_cols = [c for c in right.columns if c not in (key, _MATCH)]
    if null_keys_by is None:
        merged = transactions.join(right, on=key, how="left")
    else:
        spread = F.when(F.col(key).isNull(), F.xxhash64(null_keys_by)).otherwise(F.lit(0).cast("long"))
        merged = (transactions.withColumn(_SPREAD, spread)
                  .join(right.withColumn(_SPREAD, F.lit(0).cast("long")), on=[key, _SPREAD], how="left"))
    return merged.select(
        *[F.col(c) for c in transactions.columns],
        *[F.col(c) for c in right_cols],
        F.coalesce(F.col(_MATCH), F.lit(0)).alias("has_identity"),
    )


def join_coverage(merged: DataFrame) -> DataFrame:
    """Rows, matched rows, matched percent and unmatched rows after J1 (A4)."""
    return merged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum("has_identity").cast("long").alias("with_identity"),
    ).select(
        "total_rows", "with_identity",
        ratio("with_identity", "total_rows", digits=1).alias("with_identity_pct"),
        (F.col("total_rows") - F.col("with_identity")).alias("without_identity"),
    )


def schema_listing(identity: DataFrame, key: str = KEY) -> list[tuple[int, str]]:
    """(ordinal, column) pairs of the identity table without the key."""
    return list(enumerate(identity_columns(identity, key), start=1))
