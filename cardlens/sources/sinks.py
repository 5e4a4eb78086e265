"""Sinks: Parquet / CSV files, catalog tables, marts.

Writers return the number of rows written from an ``Observation`` attached
to the write, so no stage needs an extra ``count()`` pass.  Overwrite mode
makes reruns idempotent; Spark refuses to overwrite a path that the same
plan reads.  Tables are replaced by versions: readers see the old rows or the
new ones, never none.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import delete_path, list_folder, path_exists


def write_files(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: list[str] | None = None, compression: str | None = "snappy",
                options: dict | None = None) -> dict:
    """Write ``df`` to a folder of part files at ``path`` (any Hadoop URI:
    ``file:``, ``hdfs://``, ``s3a://``, ``gs://`` ... the connector decides)
    and return ``{"path", "rows", "columns"}`` (S8, S11, A20)."""
    obs = Observation(f"write_{fmt}")
    if partition_by:
        # rows of a folder go to few files; AQE splits folders that are too large
        df = df.hint("rebalance", *partition_by)
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode(mode).format(fmt)
    if compression and fmt in ("parquet", "orc", "csv", "json"):
        w = w.option("compression", compression)
    for k, v in (options or {}).items():
        w = w.option(k, v)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.save(path)
    return {"path": path, "rows": int(obs.get["rows"]), "columns": len(df.columns)}


def write_parquet(df: DataFrame, path: str, **kw) -> dict:
    return write_files(df, path, "parquet", **kw)


def write_csv(df: DataFrame, path: str, header: bool = True, **kw) -> dict:
    """CSV folder with a header line."""
    return write_files(df, path, "csv", compression=None,
                       options={"header": str(header).lower()}, **kw)


#: Providers whose tables are folders of files that a table can be pointed at.
FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro", "text")


def replace_table(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet",
                  bucket_by: tuple[int, str] | None = None, keep: int = 1) -> dict:
    """Replace a catalog table by ``df``, all or nothing.

    The rows go to a new folder below ``path`` (use the shared warehouse; by
    default ``<table>.versions`` in the warehouse folder) while the table still
    shows the old ones.  When they are complete, the table is pointed at the
    new folder: one call to the catalog where schema and layout stay the same;
    otherwise the table is dropped and the finished one renamed, two calls
    that move no rows.  A load that fails, or one that loses a race, leaves
    the table as it was.

    Old folders are removed by rule: of the complete ones the newest ``keep``
    besides the current one stay (queries may still read them, and a load at
    the same time may be about to point there), unfinished ones go after a day.

    ``bucket_by=(n, col)`` stores the rows bucketed so that later joins or
    aggregations on ``col`` need no shuffle.  Formats of other kinds (a
    connector's ``fmt``) are overwritten by their own means.
    """
    spark = df.sparkSession
    obs = Observation(f"table_{table}")
    if bucket_by:
        df = df.repartition(*bucket_by)  # one file per bucket
    w = df.observe(obs, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").format(fmt)
    if bucket_by:
        w = w.bucketBy(bucket_by[0], bucket_by[1]).sortBy(bucket_by[1])
    if fmt not in FILE_FORMATS:
        (w.option("path", path) if path else w).saveAsTable(table)
    else:
        root = path or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{table}.versions"
        version = f"{root.rstrip('/')}/v-{uuid.uuid4().hex[:12]}"
        loading = f"{table}_loading_{uuid.uuid4().hex[:12]}"
        try:
            w.option("path", version).saveAsTable(loading)
            _point_at(spark, table, loading, version)
        except Exception:
            spark.sql(f"DROP TABLE IF EXISTS {loading}")
            raise
        sweep_versions(spark, root, version, keep)
    return {"table": table, "rows": int(obs.get["rows"]), "columns": len(df.columns)}


def _layout(spark: SparkSession, table: str) -> tuple:
    """What has to agree for a table to be pointed at another one's files."""
    rows = {r.col_name.strip(): (r.data_type or "").strip() for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    kinds = ("Type", "Provider", "Num Buckets", "Bucket Columns", "Sort Columns")
    return (spark.table(table).schema.simpleString(), *(rows.get(k) for k in kinds))


def _point_at(spark: SparkSession, table: str, loading: str, version: str) -> None:
    if spark.catalog.tableExists(table) and _layout(spark, table) == _layout(spark, loading):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{version}'")
        spark.sql(f"DROP TABLE {loading}")  # the rows belong to the folder, not to this name
    else:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
        spark.sql(f"ALTER TABLE {loading} RENAME TO {table}")
    spark.catalog.refreshTable(table)


def sweep_versions(spark: SparkSession, root: str, current: str, keep: int = 1, hours: float = 24.0) -> list[str]:
    """Delete old version folders below ``root``; returns their names."""
    now, done, gone = time.time() * 1000, [], []
    for name, changed in list_folder(spark, root):
        if not name.startswith("v-") or current.endswith("/" + name):
            continue
        if path_exists(spark, f"{root}/{name}/_SUCCESS"):
            done.append((changed, name))
        elif now - changed > hours * 3_600_000:
            gone.append(name)
    gone += [name for _, name in sorted(done, reverse=True)[keep:]]
    for name in gone:
        delete_path(spark, f"{root}/{name}")
    return gone


def warehouse_load(spark: SparkSession, parquet_path: str, table: str,
                   path: str | None = None, fmt: str = "parquet") -> DataFrame:
    """Truncate-and-load ``table`` from Parquet, schema from the files; returns
    a one-row frame with the loaded row and column count (S12).

    ``fmt`` names the table provider, so a warehouse connector can be given.
    """
    src = spark.read.parquet(parquet_path)
    info = replace_table(src, table, path=path, fmt=fmt)
    return spark.table(table).agg(F.count(F.lit(1)).alias("rows")) \
        .select("rows", F.lit(info["columns"]).alias("columns"))  # counted from the table, as a check


def stage_counts(spark: SparkSession, counts: list[tuple[str, int]]) -> DataFrame:
    """(stage, rows) from observed counts: a handful of driver-side integers."""
    return spark.createDataFrame(counts, "stage STRING, rows BIGINT")
