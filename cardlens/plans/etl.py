"""Stage composition: extract -> transform -> validate -> load -> marts -> model.

Each stage is a function of DataFrames; the chain is one lazy plan until a
stage border writes a table.  Only reports, metrics and model coefficients
reach the driver.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.clean import clean
from ..operators.features import card_aggregates, engineer_features
from ..operators.skew import DEFAULT_HOT_ROWS
from ..operators.merge import merge_identity
from ..schemas import AMOUNT, CARD, DEVICE_COLS, KEY, LABEL, NUMERIC_SENTINEL, TIME
from ..session import compile_wide_rows, path_size, scratch_path


def identity_ids_unique(identity: DataFrame, key: str = KEY) -> bool:
    """True when no identity id occurs twice.

    One aggregation over the identity key only (map-side partial counts, so a
    hot id is combined before the shuffle); ``limit(1)`` stops at the first
    duplicate found.
    """
    dup = (identity.where(F.col(key).isNotNull()).groupBy(key).count()
           .where(F.col("count") > 1).limit(1))
    return dup.count() == 0


def card_inputs(transactions: DataFrame) -> DataFrame:
    """The three columns per-card statistics need, cleaned like ``clean``."""
    return transactions.select(
        F.coalesce(F.col(CARD), F.lit(NUMERIC_SENTINEL)).alias(CARD),
        F.coalesce(F.col(AMOUNT), F.lit(NUMERIC_SENTINEL)).alias(AMOUNT),
        F.col(LABEL))


def card_statistics(transactions: DataFrame, cleaned: DataFrame, identity: DataFrame,
                    identity_unique: bool | None = None, materialize: bool = True) -> DataFrame:
    """Per-card statistics (A5) for ``transform``.

    They are defined over the merged rows.  When identity ids are unique the
    merge cannot change per-card counts, so they are taken from the
    transactions directly and the left join is evaluated once instead of
    twice; ``identity_unique=None`` checks it with one small aggregation over
    the identity key.

    The table has one row per card and is read twice downstream (the hot-card
    list and the lookup of the salted join), so by default it is computed
    once and written as Parquet below the shared checkpoint folder; that
    cuts the lineage of the feature plan, survives executor loss, and gives
    the optimizer the table's real size for its broadcast decision.
    """
    if identity_unique is None:
        identity_unique = identity_ids_unique(identity)
    stats = card_aggregates(card_inputs(transactions) if identity_unique else cleaned)
    if materialize:
        spark = stats.sparkSession
        path = scratch_path(spark, "card-statistics")
        stats.write.mode("overwrite").parquet(path)
        stats = spark.read.parquet(path)
    return stats


def transform(transactions: DataFrame, identity: DataFrame,
              identity_unique: bool | None = None, materialize_statistics: bool = True,
              hot_rows: int = DEFAULT_HOT_ROWS, null_keys_by: str | None = None) -> DataFrame:
    """merge -> clean -> features: the 71-column staging table.

    Lazy apart from the per-card statistics (see ``card_statistics``).
    Cards with more than ``hot_rows`` rows are spread over several tasks in
    the join back to the rows, rows without an id by ``null_keys_by`` (see
    ``merge_identity``).
    """
    cleaned = clean(merge_identity(transactions, identity, null_keys_by=null_keys_by))
    stats = card_statistics(transactions, cleaned, identity, identity_unique, materialize_statistics)
    return engineer_features(cleaned, stats, hot_rows=hot_rows)


# ---------------------------------------------------------------------------
# Whole stages, as the reference's jobs run them.  Each writes its output
# below ``root`` (a shared folder) and returns a small metrics dict.
# ---------------------------------------------------------------------------

def extract(spark: SparkSession, tx_csv: str, identity_csv: str, root: str,
            sample_size: int | None = None, buckets: int | None = None) -> dict:
    """CSV -> raw Parquet for both sources, with guards and summaries.

    ``buckets``: store both raw tables as catalog tables ``raw_transactions``
    / ``raw_identity`` bucketed by TransactionID, so that ``run_transform``
    merges them without shuffling either side.
    """
    from ..operators.profiles import identity_summary, transaction_summary
    from ..schemas import RAW_IDENTITY_SCHEMA, RAW_TRANSACTION_SCHEMA
    from ..sources.files import ingest_csv
    from ..sources.guards import require_paths

    require_paths(spark, {"transactions": tx_csv, "identity": identity_csv}, "extract")
    tx, c_tx = ingest_csv(spark, tx_csv, f"{root}/raw_transactions", RAW_TRANSACTION_SCHEMA,
                          limit=sample_size, table="raw_transactions" if buckets else None,
                          buckets=buckets)
    idn, c_id = ingest_csv(spark, identity_csv, f"{root}/raw_identity", RAW_IDENTITY_SCHEMA,
                           bool_columns=[], limit=sample_size, required=[KEY, *DEVICE_COLS],
                           table="raw_identity" if buckets else None, buckets=buckets)
    tx_stats = transaction_summary(tx).first().asDict()
    id_stats = identity_summary(idn).first().asDict()
    return {"transactions_file": c_tx["file"], "identity_file": c_id["file"],
            "transactions_rows": c_tx["rows"], "transactions_malformed": c_tx["malformed"],
            "identity_rows": c_id["rows"], "fraud_count": tx_stats["fraud_count"],
            "fraud_rate_pct": tx_stats["fraud_rate_pct"], "identity_distinct_ids": id_stats["unique_tx"]}


def run_transform(spark: SparkSession, root: str, partition_by: list[str] | None = None,
                  bucketed: bool = False, identity_unique: bool | None = None) -> dict:
    """raw Parquet -> 71-column staging Parquet, rows counted on the write.

    ``partition_by=["tx_day"]`` lays the table out by day, so that later
    reads filtered on the day skip whole folders (partition pruning).
    ``bucketed=True`` reads the bucketed catalog tables written by
    ``extract(buckets=...)``; bucketing is only known through the catalog.
    ``identity_unique``: known from the extract summary, it saves the
    uniqueness check (see ``card_statistics``).
    """
    from ..sources.guards import require_paths
    from ..sources.sinks import write_parquet

    compile_wide_rows(spark)
    raw_tx, raw_id = f"{root}/raw_transactions", f"{root}/raw_identity"
    require_paths(spark, {"raw_transactions": raw_tx, "raw_identity": raw_id}, "transform")
    tx = spark.table("raw_transactions") if bucketed else spark.read.parquet(raw_tx)
    idn = spark.table("raw_identity") if bucketed else spark.read.parquet(raw_id)
    # buckets fix where a row without an id is joined; without them such rows are spread
    features = transform(tx, idn, identity_unique=identity_unique, null_keys_by=None if bucketed else TIME)
    info = write_parquet(features, f"{root}/staging_fraud", partition_by=partition_by)
    return {"feature_rows": info["rows"], "parquet_path": info["path"],
            "parquet_bytes": path_size(spark, info["path"])}


def validate(spark: SparkSession, root: str, **suite_args) -> dict:
    """16 checks on the staging table; raises ``QualityGateError`` on failure."""
    from ..operators.quality import gate, run_checks, staging_suite, summarize
    from ..schemas import QUALITY_COLUMNS
    from ..sources.files import read_parquet
    from ..sources.guards import require_paths

    require_paths(spark, {"staging": f"{root}/staging_fraud"}, "validate")
    staged = read_parquet(spark, f"{root}/staging_fraud", QUALITY_COLUMNS)
    report = run_checks(staged, staging_suite(**suite_args)).persist()
    summary = summarize(report).first().asDict()
    gate(report)
    report.unpersist()
    return summary


def load(spark: SparkSession, root: str, table: str = "staging_fraud",
         table_path: str | None = None, fmt: str = "parquet",
         object_store: str | None = None, **soft_args) -> dict:
    """Staging Parquet -> catalog table, read-back profile and soft checks.

    ``object_store``: also copy the staging table to that URI first and load
    the table from the copy (S11)."""
    from ..operators.profiles import load_readback
    from ..operators.quality import run_checks, soft_load_checks
    from ..sources.guards import require_paths
    from ..sources.sinks import warehouse_load, write_parquet

    source = f"{root}/staging_fraud"
    require_paths(spark, {"staging": source}, "load")
    if object_store:
        write_parquet(spark.read.parquet(source), object_store)
        source = object_store
    loaded = warehouse_load(spark, source, table, path=table_path, fmt=fmt).first()
    t = spark.table(table)
    readback = load_readback(t).first().asDict()
    warnings = [r.asDict() for r in run_checks(t, soft_load_checks(**soft_args))
                .where("NOT success").collect()]
    return {"rows": loaded["rows"], "columns": loaded["columns"], **readback, "warnings": warnings}


def build_marts(spark: SparkSession, source: DataFrame | None, root: str) -> dict:
    """stg_fraud view + fraud_summary / fraud_hourly tables + 17 schema tests.

    ``source`` is the staging table (None: the one below ``root``)."""
    from ..operators import marts as MT
    from ..sources.guards import require_paths
    from ..sources.sinks import replace_table

    if source is None:
        require_paths(spark, {"staging": f"{root}/staging_fraud"}, "build_marts")
        source = spark.read.parquet(f"{root}/staging_fraud")
    stg = MT.stg_fraud(source)
    stg.createOrReplaceTempView("stg_fraud")
    s = replace_table(MT.fraud_summary(stg, ordered=False), "fraud_summary", path=f"{root}/fraud_summary")
    h = replace_table(MT.fraud_hourly(stg, ordered=False), "fraud_hourly", path=f"{root}/fraud_hourly")
    tests = mart_tests(source, spark.table("fraud_summary"), spark.table("fraud_hourly"))
    failed = [r.asDict() for r in tests.where("NOT success").collect()]
    return {"fraud_summary_rows": s["rows"], "fraud_hourly_rows": h["rows"], "failed_tests": failed}


def mart_tests(source: DataFrame, summary: DataFrame, hourly: DataFrame) -> DataFrame:
    """The 17 schema tests; those of ``stg_fraud`` are tests of the rows and
    columns of ``source`` that the view shows."""
    from ..operators import marts as MT
    from ..operators import quality as QC
    from ..schemas import AMOUNT, STG_RENAMES

    view = QC.View("staging_fraud", MT.has_value(AMOUNT), {b: a for a, b in STG_RENAMES})
    return QC.schema_tests({"staging_fraud": (source, QC.SOURCE_TESTS), "stg_fraud": (view, QC.STG_TESTS),
                            "fraud_summary": (summary, QC.SUMMARY_TESTS), "fraud_hourly": (hourly, QC.HOURLY_TESTS)})


def experiments(spark: SparkSession, root: str, configs=None, parallelism: int | None = None,
                cache: bool = False, registered_name: str = "fraud_model") -> dict:
    """Three logistic-regression runs on the staging table, logged to a runs
    table (M1-M12).  Each run's model becomes the next version of
    ``registered_name`` below ``root/models``."""
    from ..operators import model as ML
    from ..schemas import LABEL, MODEL_FEATURES
    from ..sources.guards import require_paths
    from ..sources.sinks import write_csv, write_parquet

    require_paths(spark, {"staging": f"{root}/staging_fraud"}, "experiments")
    staged = spark.read.parquet(f"{root}/staging_fraud")
    present, missing = ML.select_features(staged, MODEL_FEATURES)
    # The split is read by every run, so it is stored once, by part.
    path = scratch_path(spark, "split")
    (ML.stratified_split(ML.fill_features(staged.select("TransactionID", LABEL, *present), present))
     .write.partitionBy("split").parquet(path))
    df = spark.read.parquet(path)
    train, test = df.where("split = 'train'"), df.where("split = 'test'")
    runs = ML.run_experiments(train, test, present, configs, parallelism, cache)
    for r in runs:
        r.version = ML.claim_version(spark, f"{root}/models", registered_name)

    def store(r):  # small jobs, submitted together
        _, r.model_path = ML.register_model(r.model, f"{root}/models", registered_name, r.version)
        write_csv(ML.feature_importance(spark, r.model, present), f"{root}/feature_analysis/{r.run_name}")

    with ThreadPoolExecutor(max(1, len(runs))) as pool:
        list(pool.map(store, runs))
    write_parquet(ML.runs_frame(spark, runs), f"{root}/runs", mode="append")
    return {"missing_features": missing, "runs": {r.run_name: r.metrics for r in runs},
            "versions": {r.run_name: r.version for r in runs}}


def run_all_stages(spark: SparkSession, tx_csv: str, identity_csv: str, root: str,
                 sample_size: int | None = None, buckets: int | None = None,
                 suite_args: dict | None = None, soft_args: dict | None = None,
                 train_models: bool = True) -> dict:
    """All stages in order, each writing below ``root``; returns their metrics.

    A failed quality gate stops the run before anything is loaded, like the
    hard failure of the validation stage it replaces.
    """
    out = {"extract": extract(spark, tx_csv, identity_csv, root, sample_size, buckets)}
    ex = out["extract"]
    # Exact row and distinct-id counts of the identity source are already
    # known; equal counts mean unique ids (NULL ids make them differ, which
    # only selects the slower, always-correct form).
    out["transform"] = run_transform(spark, root, bucketed=bool(buckets),
                                     identity_unique=ex["identity_rows"] == ex["identity_distinct_ids"])
    out["validate"] = validate(spark, root, **(suite_args or {}))
    out["load"] = load(spark, root, table_path=f"{root}/warehouse/staging_fraud", **(soft_args or {}))
    out["marts"] = build_marts(spark, None, root)
    if train_models:
        out["experiments"] = experiments(spark, root)
    return out
