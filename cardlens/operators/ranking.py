"""Distributed running sums without a single-partition window.

``Window.orderBy(...)`` without ``partitionBy`` moves every row to one task.
Here each row carries a *bucket*: a deterministic column that is
non-decreasing in the sort order (a hash fraction scaled to the bucket
count, or the range of a score that a stored range partitioning put it in).  Each bucket is
one window partition; the per-bucket totals (one row per bucket and group,
so bounded by the bucket count, not by the data) give every bucket its
offset.  The bucket is a pure function of the row, so the two branches of
the plan (totals and rows) agree however often they are recomputed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path

_B = "__bucket"


def fraction_bucket(fraction: Column, buckets: int) -> Column:
    """Bucket of a number in [0, 1]: ``floor(fraction * buckets)``, 1.0 in the last one."""
    b = F.floor(fraction * F.lit(float(buckets)))
    return F.greatest(F.least(b, F.lit(buckets - 1)), F.lit(0)).cast("int")


def with_range_bucket(df: DataFrame, column: str | list[str], out: str, partitions: int | None = None) -> DataFrame:
    """``df`` written once in ranges of ``column`` (or columns), with ``out``:
    the range's number.  Equal values share a range, and ranges ascend with
    ``column``.
    The stored table fixes the numbers, so a lost executor cannot change them.
    """
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = scratch_path(spark, "ranges")
    df.repartitionByRange(n, *([column] if isinstance(column, str) else column)).withColumn(out, F.spark_partition_id()).write.parquet(path)
    return spark.read.parquet(path)


def bucket_count(rows: int, rows_per_bucket: int = 1_000_000, minimum: int = 16) -> int:
    """Buckets so that each holds about ``rows_per_bucket`` rows."""
    return int(max(minimum, -(-rows // rows_per_bucket)))


def running_sum(df: DataFrame, order_cols: list[str], value: str, out: str,
                bucket: Column | str, by: list[str] | None = None,
                inclusive: bool = True) -> DataFrame:
    """Add ``out`` = sum of ``value`` over the rows before (and, with
    ``inclusive``, including) each row in ``order_cols`` order, per ``by`` group.

    ``bucket`` (a column expression, or the name of an existing column) must
    be non-decreasing in ``order_cols`` within a group, and ``order_cols`` must
    be a total order (end with a unique key).
    """
    by = by or []
    rows = df.withColumn(_B, F.col(bucket) if isinstance(bucket, str) else bucket)
    if isinstance(bucket, str) and bucket != _B:
        rows = rows.drop(bucket)
    totals = rows.groupBy(*(by + [_B])).agg(F.sum(value).alias("__bucket_total"))
    w_tot = (Window.partitionBy(*by) if by else Window.partitionBy()).orderBy(_B)
    offsets = totals.select(*by, _B, F.coalesce(F.sum("__bucket_total").over(
        w_tot.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("__offset"))
    w_in = Window.partitionBy(*(by + [_B])).orderBy(*order_cols)
    frame = w_in.rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    local = rows.withColumn("__local", F.coalesce(F.sum(value).over(frame), F.lit(0)))
    # One row per (group, bucket); the optimizer sees its size.
    return (local.join(offsets, on=by + [_B], how="left")
            .withColumn(out, F.col("__local") + F.col("__offset"))
            .drop("__local", "__offset", _B))
