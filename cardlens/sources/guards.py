"""Fail-fast guards for missing inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import path_exists


class MissingInputError(FileNotFoundError):
    pass


def require_paths(spark: SparkSession, paths: dict[str, str], stage: str) -> None:
    """Raise naming ``stage`` and every absent input (metadata calls only)."""
    missing = [f"{name} ({p})" for name, p in paths.items() if not path_exists(spark, p)]
    if missing:
        raise MissingInputError(f"{stage}: missing input {', '.join(missing)}")


def require_tables(spark: SparkSession, tables: list[str], stage: str) -> None:
    missing = [t for t in tables if not spark.catalog.tableExists(t)]
    if missing:
        raise MissingInputError(f"{stage}: missing table {', '.join(missing)}; run the upstream stage first")


def input_report(spark: SparkSession, paths: dict[str, str], stage: str) -> DataFrame:
    """Guard, then one row per input with its row count: the first stage of a run."""
    require_paths(spark, paths, stage)
    out = None
    for name, p in paths.items():
        part = spark.read.parquet(p).agg(F.count(F.lit(1)).alias("row_count")) \
            .select(F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    return out
