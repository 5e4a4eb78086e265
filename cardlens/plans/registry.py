"""Registered queries: one per operator key, each with its DuckDB oracle.

``QUERIES[key](spark, sf_dir)`` returns a lazy DataFrame over the test
tables of ``sf_dir``; ``ORACLE[key]`` recomputes the same result in DuckDB
SQL from the base views.  Every query reads the whole
``events`` table (through the adapter), so its work grows with the data.
The listing of a table's columns and the check for missing ones read no rows
and are tested as units instead.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.rounding import money_avg, money_sum, half_away, ratio
from ..functions.scalar import safe_divide
from ..operators import marts as MT
from ..operators import model as ML
from ..operators import profiles as PR
from ..operators import quality as QC
from ..operators.clean import missing_profile
from ..operators.features import feature_summary
from ..operators.merge import join_coverage
from ..schemas import (KEY, M_COLS, MODEL_FEATURES, NUMERIC_FILL, QUALITY_COLUMNS, RAW_TRANSACTION_SCHEMA,
                       STG_RENAMES, STRING_FILL)
from ..session import scratch_path
from ..sources import files as FS
from ..sources import guards as GD
from ..sources import sinks as SK
from . import oracle as O
from .stages import model_frame, round6, split_parts, stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(key: str, sql: str | None = None):
    def deco(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLE[key] = sql
        return fn
    return deco


LOG6 = O.round6("log_TransactionAmt")
STAGING_SQL = O.with_stage("staging", f"SELECT * REPLACE ({LOG6}) FROM staging")


# ===========================================================================
# Flagship: the 71-column staging table (merge -> clean -> features)
# ===========================================================================
@register("features", STAGING_SQL)
def q_features(spark, sf):
    return round6(stages(spark, sf).staging, "log_TransactionAmt")


# ===========================================================================
# 2.1 Scans, sources, sinks
# ===========================================================================

#: Columns that the schema does not know, as SQL for both engines: the ingest
#: has to find their types.  V4 is a number but in a few rows, V6 is empty, and
#: the note holds quotes, commas and line breaks.
_EXTRA_COLUMNS = {
    "V1": "CASE WHEN TransactionID % 7 = 0 THEN NULL ELSE CAST(TransactionID AS DOUBLE) / 2 END",
    "V2": "CASE WHEN TransactionID % 5 = 0 THEN NULL ELSE TransactionID * 1000003 END",
    "V3": "TransactionID % 3 = 0",
    "V4": "CASE WHEN TransactionID % 400 = 11 THEN 'x' || {id} ELSE {id} END",
    "V5": "CASE WHEN TransactionID % 11 = 0 THEN NULL ELSE DATE '2020-01-01' + CAST(TransactionID % 500 AS INT) END",
    "V6": "CAST(NULL AS {text})",
    "note": "CASE WHEN TransactionID % 40 = 9 THEN 'first, \"' || {id} || '\"\n\nlast' ELSE 'plain' END",
}


def _extra_columns(text: str) -> list[str]:
    names = {"id": f"CAST(TransactionID AS {text})", "text": text}
    return [f"{e.format(**names)} AS {c}" for c, e in _EXTRA_COLUMNS.items()]


def _raw_csv(spark: SparkSession, sf: str) -> str:
    """Transactions written as a CSV source with further columns, plus malformed
    copies of some rows (text in numeric columns) that the ingest must drop."""
    s = stages(spark, sf)
    path = f"{scratch_path(spark, 'raw-csv')}/transactions.csv"
    rows = s.tx.selectExpr("*", *_extra_columns("STRING"))
    rows.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    bad = (rows.where(F.col(KEY) % 250 == 3)
           .select(*[F.lit("n/a").alias(c) if c in (KEY, "TransactionAmt") else F.col(c).cast("string")
                     for c in rows.columns]))
    bad.write.mode("append").option("header", True).option("escape", '"').csv(path)
    return path


@register("csv_ingest", O.with_stage("tx", f"""
SELECT * REPLACE (CAST(V5 AS VARCHAR) AS V5), 'double bigint boolean string date string string' AS types_found
FROM (SELECT *, {', '.join(_extra_columns('VARCHAR'))} FROM tx)"""))
def q_csv_ingest(spark, sf):
    src = _raw_csv(spark, sf)
    df, _counts = FS.ingest_csv(spark, src, scratch_path(spark, "raw-transactions"),
                                RAW_TRANSACTION_SCHEMA)
    kinds = dict(df.dtypes)
    return df.withColumns({"V5": F.col("V5").cast("string"),
                           "types_found": F.lit(" ".join(kinds[c] for c in _EXTRA_COLUMNS))})


@register("sample_limit", O.with_stage("tx", "SELECT * FROM tx ORDER BY TransactionID LIMIT 1000"))
def q_sample_limit(spark, sf):
    return FS.sample_limit(stages(spark, sf).tx, 1000)


@register("sample_limit_text", O.with_stage("tx", """
SELECT TransactionID, MD5(CAST(TransactionID AS VARCHAR)) AS key FROM tx ORDER BY key LIMIT 1000"""))
def q_sample_limit_text(spark, sf):
    keyed = stages(spark, sf).tx.select(KEY, F.md5(F.col(KEY).cast("string").cast("binary")).alias("key"))
    return FS.sample_limit(keyed, 1000, "key")


@register("source_row_count", O.with_stage("tx", """
SELECT 'transactions.csv' AS file_name, COUNT(*) AS row_count,
       COUNT(*) FILTER (TransactionID % 250 = 3) AS malformed_rows FROM tx"""))
def q_source_row_count(spark, sf):
    return FS.source_row_count(spark, _raw_csv(spark, sf), RAW_TRANSACTION_SCHEMA)


@register("source_guard", "SELECT 'events' AS table_name, COUNT(*) AS row_count FROM events")
def q_source_guard(spark, sf):
    return GD.input_report(spark, {"events": f"{sf}/events.parquet"}, "extract")


_CODES = [("W", 1), ("H", 2), ("C", 3), ("S", 4), ("R", 5), ("unknown", 6)]


@register("inline_values", O.with_stage("cleaned", """
SELECT v.ProductCD, v.code_rank, COALESCE(c.transactions, 0) AS transactions
FROM (VALUES ('W', 1), ('H', 2), ('C', 3), ('S', 4), ('R', 5), ('unknown', 6)) AS v(ProductCD, code_rank)
LEFT JOIN (SELECT ProductCD, COUNT(*) AS transactions FROM cleaned GROUP BY ProductCD) c
  ON v.ProductCD = c.ProductCD"""))
def q_inline_values(spark, sf):
    codes = FS.inline_table(spark, _CODES, "ProductCD STRING, code_rank INT")
    counts = stages(spark, sf).cleaned.groupBy("ProductCD").agg(F.count(F.lit(1)).alias("transactions"))
    # The literal side has 6 rows: a proven-small broadcast.
    return (F.broadcast(codes).join(counts, "ProductCD", "left")
            .select("ProductCD", "code_rank",
                    F.coalesce("transactions", F.lit(0).cast("long")).alias("transactions")))


@register("ctas_replace", O.with_stage("cleaned", "SELECT * FROM cleaned"))
def q_ctas_replace(spark, sf):
    s = stages(spark, sf)
    SK.replace_table(s.cleaned, "cleaned_data", path=scratch_path(spark, "cleaned-table"))
    return spark.table("cleaned_data")


def _staging_parquet(spark, sf) -> str:
    path = scratch_path(spark, "staging-parquet")
    SK.write_parquet(stages(spark, sf).staging, path)
    return path


@register("parquet_sink", STAGING_SQL)
def q_parquet_sink(spark, sf):
    return round6(spark.read.parquet(_staging_parquet(spark, sf)), "log_TransactionAmt")


_FEATURE_LIST = ", ".join(c for c in O.MODEL if c != "log_TransactionAmt")


@register("parquet_scan", O.with_stage("staging", f"SELECT TransactionID, isFraud, {_FEATURE_LIST}, {LOG6} FROM staging"))
def q_parquet_scan(spark, sf):
    df = FS.read_parquet(spark, _staging_parquet(spark, sf), [KEY, "isFraud"] + MODEL_FEATURES)
    return round6(df, "log_TransactionAmt")


_QUALITY_LIST = ", ".join(c for c in O.QUALITY if c != "log_TransactionAmt")


@register("staging_projection", O.with_stage("staging", f"SELECT {_QUALITY_LIST}, {LOG6} FROM staging"))
def q_staging_projection(spark, sf):
    df = FS.read_parquet(spark, _staging_parquet(spark, sf), QUALITY_COLUMNS)
    return round6(df, "log_TransactionAmt")


@register("object_store_sink", O.with_stage("cleaned", "SELECT * FROM cleaned"))
def q_object_store_sink(spark, sf):
    path = scratch_path(spark, "object-store")
    uri = path if "://" in path or path.startswith("file:") else "file://" + path
    SK.write_parquet(stages(spark, sf).cleaned, uri)
    return spark.read.parquet(uri)


@register("warehouse_load", O.with_stage("staging", "SELECT COUNT(*) AS rows, 71 AS columns FROM staging"))
def q_warehouse_load(spark, sf):
    return SK.warehouse_load(spark, _staging_parquet(spark, sf), "staging_fraud",
                             path=scratch_path(spark, "warehouse-staging"))


# ===========================================================================
# 2.4 / 2.5 / 2.6 Marts (SQL text shared by several keys)
# ===========================================================================
SUMMARY_BODY = f"""
SELECT card1, card4 AS card_network, card6 AS card_type,
  COUNT(*) AS total_transactions,
  CAST(SUM(is_fraud) AS BIGINT) AS fraud_transactions,
  {O.ratio('SUM(is_fraud)', 'COUNT(is_fraud)')} AS fraud_rate_pct,
  {O.half_away('MIN(transaction_amt)', 2)} AS min_amount,
  {O.half_away('MAX(transaction_amt)', 2)} AS max_amount,
  {O.money_avg('transaction_amt')} AS avg_amount,
  {O.money_sum('transaction_amt')} AS total_amount,
  CAST(SUM(is_night_tx) AS BIGINT) AS night_transactions,
  CAST(SUM(is_weekend) AS BIGINT) AS weekend_transactions,
  CAST(SUM(is_large_tx) AS BIGINT) AS large_transactions,
  CAST(SUM(has_identity) AS BIGINT) AS transactions_with_identity,
  {O.ratio('SUM(CASE WHEN is_fraud = 1 AND is_night_tx = 1 THEN 1 ELSE 0 END)', 'SUM(is_fraud)')} AS fraud_night_pct
FROM stg_fraud GROUP BY card1, card4, card6 HAVING COUNT(*) >= 5"""
SUMMARY_CTE = f"fraud_summary AS ({SUMMARY_BODY})"

HOURLY_AGG = f"""
SELECT tx_hour, is_night_tx,
  COUNT(*) AS total_transactions,
  CAST(SUM(is_fraud) AS BIGINT) AS fraud_transactions,
  {O.ratio('SUM(is_fraud)', 'COUNT(is_fraud)')} AS fraud_rate_pct,
  {O.money_avg('transaction_amt')} AS avg_amount,
  {O.money_sum('CASE WHEN is_fraud = 1 THEN transaction_amt ELSE 0.0 END')} AS fraud_total_amount
FROM stg_fraud GROUP BY tx_hour, is_night_tx"""
HOURLY_CTE = f"""fraud_hourly AS (
SELECT *, {O.ratio('total_transactions', 'SUM(total_transactions) OVER ()')} AS pct_of_daily_volume,
          {O.ratio('fraud_transactions', 'SUM(fraud_transactions) OVER ()')} AS pct_of_daily_fraud
FROM ({HOURLY_AGG}))"""


def _summary(spark, sf, ordered=True):
    return MT.fraud_summary(stages(spark, sf).narrow, ordered=ordered)


def _hourly(spark, sf, ordered=True):
    return MT.fraud_hourly(stages(spark, sf).narrow, ordered=ordered)


@register("warehouse_reload", O.with_stage("cleaned", """
SELECT TransactionID, ProductCD, TransactionAmt FROM cleaned WHERE TransactionID % 2 = 0"""))
def q_warehouse_reload(spark, sf):
    """Loaded twice, then by a load that fails: the second load's rows stay."""
    rows = stages(spark, sf).cleaned.select(KEY, "ProductCD", "TransactionAmt")
    path, table = scratch_path(spark, "reloaded"), "reloaded_fraud"
    SK.replace_table(rows, table, path=path)
    SK.replace_table(rows.where(F.col(KEY) % 2 == 0), table, path=path)
    broken = rows.withColumn(KEY, F.when(F.col(KEY) % 500 == 1, F.raise_error(F.lit("broken row")).cast("long"))
                             .otherwise(F.col(KEY)))
    try:
        SK.replace_table(broken, table, path=path)
    except Exception as e:  # the load's failure is part of the query
        if "broken row" not in str(e):
            raise
    return spark.table(table)


@register("mart_materialise", O.with_stage("stg_fraud", "SELECT * FROM fraud_summary", [SUMMARY_CTE]))
def q_mart_materialise(spark, sf):
    s = stages(spark, sf)
    s.stg.createOrReplaceTempView("stg_fraud")            # the staging model is a view
    SK.replace_table(MT.fraud_summary(spark.table("stg_fraud"), ordered=False), "fraud_summary",
                     path=scratch_path(spark, "mart-fraud-summary"))
    return spark.table("fraud_summary")


# ===========================================================================
# 2.2 Projections, filters, predicates
# ===========================================================================
@register("dynamic_projection", O.with_stage("merged", "SELECT * FROM merged"))
def q_dynamic_projection(spark, sf):
    return stages(spark, sf).merged


@register("match_flag", O.with_stage("merged", "SELECT TransactionID, has_identity FROM merged"))
def q_match_flag(spark, sf):
    return stages(spark, sf).merged.select(KEY, "has_identity")


@register("fill_numeric", O.with_stage("cleaned", f"SELECT TransactionID, {', '.join(O.NUMERIC)} FROM cleaned"))
def q_fill_numeric(spark, sf):
    return stages(spark, sf).cleaned.select(KEY, *NUMERIC_FILL)


@register("fill_string", O.with_stage("cleaned", f"SELECT TransactionID, {', '.join(O.TEXT)} FROM cleaned"))
def q_fill_string(spark, sf):
    return stages(spark, sf).cleaned.select(KEY, *STRING_FILL)


@register("bool_passthrough", O.with_stage("cleaned", f"SELECT TransactionID, {', '.join(O.MATCHES)} FROM cleaned"))
def q_bool_passthrough(spark, sf):
    return stages(spark, sf).cleaned.select(KEY, *M_COLS)


@register("column_prune", O.with_stage("cleaned", "SELECT * FROM cleaned"))
def q_column_prune(spark, sf):
    return stages(spark, sf).cleaned


@register("rename_projection", O.with_stage(
    "stg_fraud", f"SELECT * REPLACE ({O.round6('log_transaction_amt')}) FROM stg_fraud"))
def q_rename_projection(spark, sf):
    return round6(stages(spark, sf).stg, "log_transaction_amt")


@register("filter_sentinel", O.with_stage("cleaned", "SELECT TransactionID, card1 FROM cleaned WHERE card1 <> -999"))
def q_filter_sentinel(spark, sf):
    return MT.drop_sentinel(stages(spark, sf).cleaned, "card1").select(KEY, "card1")


@register("filter_equality", O.with_stage("staging", f"SELECT * REPLACE ({LOG6}) FROM staging WHERE TransactionID = 1"))
def q_filter_equality(spark, sf):
    return round6(stages(spark, sf).staging.where(F.col(KEY) == 1), "log_TransactionAmt")


@register("filter_comparison", O.with_stage("staging", "SELECT TransactionID, TransactionAmt FROM staging WHERE TransactionAmt > 0"))
def q_filter_comparison(spark, sf):
    return stages(spark, sf).staging.where(F.col("TransactionAmt") > 0).select(KEY, "TransactionAmt")


@register("pred_not_between", O.with_stage("staging", "SELECT TransactionID, tx_hour FROM staging WHERE tx_hour NOT BETWEEN 6 AND 21"))
def q_pred_not_between(spark, sf):
    return stages(spark, sf).staging.where(~F.col("tx_hour").between(6, 21)).select(KEY, "tx_hour")


@register("pred_in", O.with_stage("staging", "SELECT TransactionID, tx_day_of_week FROM staging WHERE tx_day_of_week IN (5, 6)"))
def q_pred_in(spark, sf):
    return stages(spark, sf).staging.where(F.col("tx_day_of_week").isin(5, 6)).select(KEY, "tx_day_of_week")


@register("pred_null_and_range", O.with_stage(
    "card_agg", "SELECT card1, card1_avg_amt FROM card_agg WHERE card1_avg_amt IS NOT NULL AND card1_avg_amt > 0"))
def q_pred_null_and_range(spark, sf):
    a = stages(spark, sf).card_agg
    return a.where(F.col("card1_avg_amt").isNotNull() & (F.col("card1_avg_amt") > 0)).select("card1", "card1_avg_amt")


@register("feature_select", O.with_stage("staging", f"SELECT TransactionID, {_FEATURE_LIST}, {LOG6} FROM staging"))
def q_feature_select(spark, sf):
    s = stages(spark, sf)
    present, _missing = ML.select_features(s.staging)
    return round6(s.staging.select(KEY, *present), "log_TransactionAmt")


_RAW_FEATURES = [c for c in O.MODEL if c in O.CLEAN]


@register("fill_features", O.with_stage("merged", "SELECT TransactionID, " + ", ".join(
    f"COALESCE({c}, -999) AS {c}" for c in _RAW_FEATURES) + " FROM merged"))
def q_fill_features(spark, sf):
    m = stages(spark, sf).merged
    present, _ = ML.select_features(m)
    return ML.fill_features(m.select(KEY, *present), present)


# ===========================================================================
# 2.3 Joins
# ===========================================================================
@register("left_join_identity", O.with_stage(
    "merged", "SELECT TransactionID, id_01, id_DeviceType, id_DeviceInfo, has_identity FROM merged"))
def q_left_join_identity(spark, sf):
    return stages(spark, sf).merged.select(KEY, "id_01", "id_DeviceType", "id_DeviceInfo", "has_identity")


_J2_COLS = ["card1", "card1_tx_count", "card1_avg_amt", "card1_max_amt", "card1_std_amt",
            "card1_fraud_count", "amt_deviation_from_card_mean"]


@register("left_join_card_aggregates", O.with_stage("staging", f"SELECT TransactionID, {', '.join(_J2_COLS)} FROM staging"))
def q_left_join_card_aggregates(spark, sf):
    return stages(spark, sf).staging.select(KEY, *_J2_COLS)


# ===========================================================================
# 2.4 Aggregations
# ===========================================================================
@register("tx_summary", O.with_stage("tx", f"""
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT TransactionID) AS unique_tx,
  {O.half_away('MIN(TransactionAmt)', 2)} AS min_amount, {O.half_away('MAX(TransactionAmt)', 2)} AS max_amount,
  {O.money_avg('TransactionAmt')} AS avg_amount, CAST(SUM(isFraud) AS BIGINT) AS fraud_count,
  {O.ratio('SUM(isFraud)', 'COUNT(isFraud)')} AS fraud_rate_pct,
  COUNT(*) - COUNT(TransactionAmt) AS missing_amounts
FROM tx"""))
def q_tx_summary(spark, sf):
    return PR.transaction_summary(stages(spark, sf).tx)


@register("identity_summary", O.with_stage(
    "idn", "SELECT COUNT(*) AS total_rows, COUNT(DISTINCT TransactionID) AS unique_tx FROM idn"))
def q_identity_summary(spark, sf):
    return PR.identity_summary(stages(spark, sf).idn)


_MISSING = ["TransactionAmt", "card1", "P_emaildomain", "addr1"]


@register("missing_profile", O.with_stage("merged", "SELECT " + ", ".join(
    f"COUNT(*) - COUNT({c}) AS missing_{c}" for c in _MISSING) + " FROM merged"))
def q_missing_profile(spark, sf):
    return missing_profile(stages(spark, sf).merged, _MISSING)


@register("join_coverage", O.with_stage("merged", f"""
SELECT total_rows, with_identity, {O.ratio('with_identity', 'total_rows', 1)} AS with_identity_pct,
       total_rows - with_identity AS without_identity
FROM (SELECT COUNT(*) AS total_rows, CAST(SUM(has_identity) AS BIGINT) AS with_identity FROM merged)"""))
def q_join_coverage(spark, sf):
    return join_coverage(stages(spark, sf).merged)


@register("card_aggregates", O.with_stage("card_agg", "SELECT * FROM card_agg"))
def q_card_aggregates(spark, sf):
    return stages(spark, sf).card_agg


@register("feature_summary", O.with_stage("staging", f"""
SELECT {O.ratio('SUM(tx_hour)', 'COUNT(tx_hour)', 1, 1.0)} AS avg_hour,
  CAST(SUM(is_night_tx) AS BIGINT) AS night_tx_count, CAST(SUM(is_weekend) AS BIGINT) AS weekend_count,
  {O.half_away('AVG(log_TransactionAmt)', 3)} AS avg_log_amt
FROM staging"""))
def q_feature_summary(spark, sf):
    return feature_summary(stages(spark, sf).staging)


@register("load_readback", O.with_stage("staging", f"""
SELECT COUNT(*) AS total_rows, CAST(SUM(isFraud) AS BIGINT) AS fraud_count,
  {O.ratio('SUM(isFraud)', 'COUNT(isFraud)')} AS fraud_rate_pct,
  {O.half_away('MIN(TransactionAmt)', 2)} AS min_amount, {O.half_away('MAX(TransactionAmt)', 2)} AS max_amount,
  {O.money_avg('TransactionAmt')} AS avg_amount,
  CAST(COUNT_IF(TransactionAmt = -999) AS BIGINT) AS missing_amounts,
  COUNT(DISTINCT card1) AS unique_cards
FROM staging"""))
def q_load_readback(spark, sf):
    return PR.load_readback(spark.read.parquet(_staging_parquet(spark, sf)))


@register("fraud_summary", O.with_stage("stg_fraud", SUMMARY_BODY))
def q_fraud_summary(spark, sf):
    return _summary(spark, sf)


@register("having_filter", O.with_stage(
    "stg_fraud", "SELECT card1, card_network, card_type, total_transactions FROM fraud_summary", [SUMMARY_CTE]))
def q_having_filter(spark, sf):
    return _summary(spark, sf, ordered=False).select("card1", "card_network", "card_type", "total_transactions")


@register("fraud_hourly", O.with_stage("stg_fraud", "SELECT * FROM fraud_hourly", [HOURLY_CTE]))
def q_fraud_hourly(spark, sf):
    return _hourly(spark, sf)


@register("conditional_sum", O.with_stage("stg_fraud", f"""
SELECT tx_hour, {O.money_sum('CASE WHEN is_fraud = 1 THEN transaction_amt ELSE 0.0 END')} AS fraud_total_amount
FROM stg_fraud GROUP BY tx_hour"""))
def q_conditional_sum(spark, sf):
    amt = F.col("transaction_amt")
    return stages(spark, sf).narrow.groupBy("tx_hour").agg(
        money_sum(F.when(F.col("is_fraud") == 1, amt).otherwise(F.lit(0.0))).alias("fraud_total_amount"))


@register("conditional_ratio", O.with_stage("stg_fraud", f"""
SELECT card1, card4, card6,
  {O.ratio('SUM(CASE WHEN is_fraud = 1 AND is_night_tx = 1 THEN 1 ELSE 0 END)', 'SUM(is_fraud)')} AS fraud_night_pct
FROM stg_fraud GROUP BY card1, card4, card6"""))
def q_conditional_ratio(spark, sf):
    night_fraud = MT.conditional_sum((F.col("is_fraud") == 1) & (F.col("is_night_tx") == 1), F.lit(1))
    return stages(spark, sf).narrow.groupBy("card1", "card4", "card6").agg(
        ratio(night_fraud, F.sum("is_fraud")).alias("fraud_night_pct"))


@register("fraud_rate", O.with_stage("stg_fraud", f"""
SELECT product_cd, {O.ratio('SUM(is_fraud)', 'COUNT(is_fraud)')} AS fraud_rate_pct FROM stg_fraud GROUP BY product_cd"""))
def q_fraud_rate(spark, sf):
    return stages(spark, sf).narrow.groupBy("product_cd").agg(MT.fraud_rate_pct().alias("fraud_rate_pct"))


_FLAGS = ["is_night_tx", "is_weekend", "is_large_tx", "has_identity"]
_FLAG_NAMES = ["night_transactions", "weekend_transactions", "large_transactions", "transactions_with_identity"]


@register("flag_sums", O.with_stage("stg_fraud", "SELECT card6, " + ", ".join(
    f"CAST(SUM({f}) AS BIGINT) AS {n}" for f, n in zip(_FLAGS, _FLAG_NAMES)) + " FROM stg_fraud GROUP BY card6"))
def q_flag_sums(spark, sf):
    return stages(spark, sf).narrow.groupBy("card6").agg(*MT.flag_sums(_FLAGS, _FLAG_NAMES))


@register("amount_stats", O.with_stage("stg_fraud", f"""
SELECT card4, {O.half_away('MIN(transaction_amt)', 2)} AS min_amount, {O.half_away('MAX(transaction_amt)', 2)} AS max_amount,
  {O.money_avg('transaction_amt')} AS avg_amount, {O.money_sum('transaction_amt')} AS total_amount
FROM stg_fraud GROUP BY card4"""))
def q_amount_stats(spark, sf):
    amt = F.col("transaction_amt")
    return stages(spark, sf).narrow.groupBy("card4").agg(
        half_away(F.min(amt), 2).alias("min_amount"), half_away(F.max(amt), 2).alias("max_amount"),
        money_avg(amt).alias("avg_amount"), money_sum(amt).alias("total_amount"))


@register("rate_by_division", O.with_stage("tx", f"""
SELECT COUNT(*) AS total_transactions, CAST(SUM(isFraud) AS BIGINT) AS fraud_count,
  {O.money_avg('TransactionAmt')} AS avg_amount, {O.ratio('SUM(isFraud)', 'COUNT(*)', 1)} AS fraud_rate_pct
FROM tx"""))
def q_rate_by_division(spark, sf):
    return PR.rate_by_division(stages(spark, sf).tx, "isFraud", "TransactionAmt")


@register("min_max_check", O.with_stage("staging", "SELECT MIN(tx_hour) AS min_tx_hour, MAX(tx_hour) AS max_tx_hour FROM staging"))
def q_min_max_check(spark, sf):
    return PR.min_max(stages(spark, sf).staging, "tx_hour")


@register("sum_of_complement", O.with_stage(
    "merged", "SELECT CAST(SUM(has_identity) AS BIGINT) AS has_identity_ones, "
              "CAST(SUM(1 - has_identity) AS BIGINT) AS has_identity_zeros FROM merged"))
def q_sum_of_complement(spark, sf):
    return PR.sum_of_complement(stages(spark, sf).merged, "has_identity")


SPLIT_U = ("(('0x' || substr(md5('42:' || CAST(TransactionID AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)")
SPLIT_CTE = f"""split AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (PARTITION BY isFraud ORDER BY {SPLIT_U}, TransactionID)
  <= FLOOR(COUNT(*) OVER (PARTITION BY isFraud) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split FROM staging)"""


@register("class_prior", O.with_stage("staging", f"""
SELECT split AS part, {O.ratio('SUM(isFraud)', 'COUNT(isFraud)', 4, 1.0)} AS label_mean FROM split GROUP BY split
UNION ALL
SELECT 'all' AS part, {O.ratio('SUM(isFraud)', 'COUNT(isFraud)', 4, 1.0)} AS label_mean FROM staging""", [SPLIT_CTE]))
def q_class_prior(spark, sf):
    df, _ = model_frame(stages(spark, sf).staging)
    per = PR.class_prior(df, by="split").withColumnRenamed("split", "part")
    return per.unionByName(PR.class_prior(df).select(F.lit("all").alias("part"), "label_mean"))


@register("table_row_count", O.with_stage("staging", """
SELECT 'merged' AS stage, COUNT(*) AS rows FROM merged
UNION ALL SELECT 'cleaned' AS stage, COUNT(*) AS rows FROM cleaned
UNION ALL SELECT 'staging' AS stage, COUNT(*) AS rows FROM staging"""))
def q_table_row_count(spark, sf):
    from pyspark.sql import Observation
    from ..operators.clean import clean
    from ..operators.features import engineer_features
    s = stages(spark, sf)
    om, oc = Observation("merged"), Observation("cleaned")
    merged = s.merged.observe(om, F.count(F.lit(1)).alias("rows"))
    cleaned = clean(merged).observe(oc, F.count(F.lit(1)).alias("rows"))
    info = SK.write_parquet(engineer_features(cleaned, s.card_agg), scratch_path(spark, "staging-counted"))
    return SK.stage_counts(spark, [("merged", int(om.get["rows"])), ("cleaned", int(oc.get["rows"])),
                                   ("staging", info["rows"])])


# ===========================================================================
# 2.5 Window, 2.6 Sorts
# ===========================================================================
@register("share_of_total", O.with_stage(
    "stg_fraud", "SELECT tx_hour, is_night_tx, pct_of_daily_volume, pct_of_daily_fraud FROM fraud_hourly", [HOURLY_CTE]))
def q_share_of_total(spark, sf):
    return _hourly(spark, sf, ordered=False).select("tx_hour", "is_night_tx", "pct_of_daily_volume",
                                                    "pct_of_daily_fraud")


@register("sort_desc", O.with_stage(
    "stg_fraud", "SELECT card1, card_network, card_type, fraud_rate_pct FROM fraud_summary "
                 "ORDER BY fraud_rate_pct DESC", [SUMMARY_CTE]))
def q_sort_desc(spark, sf):
    return _summary(spark, sf).select("card1", "card_network", "card_type", "fraud_rate_pct")


@register("sort_asc", O.with_stage(
    "stg_fraud", "SELECT tx_hour, is_night_tx, total_transactions FROM fraud_hourly ORDER BY tx_hour", [HOURLY_CTE]))
def q_sort_asc(spark, sf):
    return _hourly(spark, sf).select("tx_hour", "is_night_tx", "total_transactions")


# ===========================================================================
# 2.8 Scalar functions and derived features
# ===========================================================================
def _staging_col(key: str, col: str, sql_expr: str | None = None):
    expr = sql_expr or col

    @register(key, O.with_stage("staging", f"SELECT TransactionID, {expr} AS {col} FROM staging"))
    def q(spark, sf):
        out = stages(spark, sf).staging.select(KEY, col)
        return round6(out, col) if sql_expr else out
    q.__name__ = f"q_{key}"
    return q


for _k, _c in [("feat_tx_hour", "tx_hour"), ("feat_tx_day_of_week", "tx_day_of_week"),
               ("feat_tx_day", "tx_day"), ("feat_is_night", "is_night_tx"),
               ("feat_is_weekend", "is_weekend"), ("feat_is_large", "is_large_tx"),
               ("feat_card_tx_count", "card1_tx_count"), ("feat_card_avg_amt", "card1_avg_amt"),
               ("feat_card_max_amt", "card1_max_amt"), ("feat_card_std_amt", "card1_std_amt"),
               ("feat_card_fraud_count", "card1_fraud_count"),
               ("feat_amt_deviation", "amt_deviation_from_card_mean")]:
    _staging_col(_k, _c)
_staging_col("feat_log_amount", "log_TransactionAmt", O.half_away("log_TransactionAmt", 6))


@register("fn_round", O.with_stage("merged", f"SELECT TransactionID, {O.half_away('TransactionAmt / 7', 2)} AS amount_sevenths FROM merged"))
def q_fn_round(spark, sf):
    return stages(spark, sf).merged.select(KEY, half_away(F.col("TransactionAmt") / 7, 2).alias("amount_sevenths"))


@register("fn_coalesce", O.with_stage(
    "merged", "SELECT TransactionID, COALESCE(P_emaildomain, R_emaildomain, 'unknown') AS email_domain FROM merged"))
def q_fn_coalesce(spark, sf):
    return stages(spark, sf).merged.select(
        KEY, F.coalesce("P_emaildomain", "R_emaildomain", F.lit("unknown")).alias("email_domain"))


@register("fn_nullif", O.with_stage("card_agg", "SELECT card1, NULLIF(card1_std_amt, 0) AS std_or_null FROM card_agg"))
def q_fn_nullif(spark, sf):
    return stages(spark, sf).card_agg.select("card1", F.nullif("card1_std_amt", F.lit(0.0)).alias("std_or_null"))


@register("fn_safe_divide", O.with_stage(
    "card_agg", "SELECT card1, CAST(card1_fraud_count AS DOUBLE) / NULLIF(CAST(card1_tx_count - 1 AS DOUBLE), 0.0) "
                "AS fraud_per_repeat FROM card_agg"))
def q_fn_safe_divide(spark, sf):
    a = stages(spark, sf).card_agg
    return a.select("card1", safe_divide(F.col("card1_fraud_count"), F.col("card1_tx_count") - 1)
                    .alias("fraud_per_repeat"))


@register("fn_greatest", O.with_stage("merged", "SELECT TransactionID, GREATEST(TransactionAmt, 0.0) AS amount_floor FROM merged"))
def q_fn_greatest(spark, sf):
    return stages(spark, sf).merged.select(KEY, F.greatest("TransactionAmt", F.lit(0.0)).alias("amount_floor"))


@register("fn_floor_mod_cast", O.with_stage(
    "merged", "SELECT TransactionID, CAST(FLOOR(TransactionDT / 60) % 60 AS INTEGER) AS tx_minute FROM merged"))
def q_fn_floor_mod_cast(spark, sf):
    return stages(spark, sf).merged.select(
        KEY, (F.floor(F.col("TransactionDT") / F.lit(60.0)) % 60).cast("int").alias("tx_minute"))


@register("fn_ln", O.with_stage("card_agg", f"SELECT card1, {O.half_away('LN(card1_tx_count)', 6)} AS ln_tx_count FROM card_agg"))
def q_fn_ln(spark, sf):
    a = stages(spark, sf).card_agg
    return a.select("card1", half_away(F.ln("card1_tx_count"), 6).alias("ln_tx_count"))


@register("fn_case_when", O.with_stage(
    "stg_fraud", "SELECT transaction_id, CASE WHEN is_fraud = 1 THEN transaction_amt ELSE 0 END AS fraud_amount FROM stg_fraud"))
def q_fn_case_when(spark, sf):
    stg = stages(spark, sf).stg
    return stg.select("transaction_id", F.when(F.col("is_fraud") == 1, F.col("transaction_amt"))
                      .otherwise(F.lit(0.0)).alias("fraud_amount"))


@register("fn_abs", O.with_stage("staging", "SELECT TransactionID, ABS(amt_deviation_from_card_mean) AS abs_deviation FROM staging"))
def q_fn_abs(spark, sf):
    return stages(spark, sf).staging.select(KEY, F.abs("amt_deviation_from_card_mean").alias("abs_deviation"))


@register("fn_round_metric", O.with_stage(
    "card_agg", f"SELECT card1, {O.ratio('card1_fraud_count', 'card1_tx_count', 4, 1.0)} AS fraud_share FROM card_agg"))
def q_fn_round_metric(spark, sf):
    a = stages(spark, sf).card_agg
    return a.select("card1", ratio("card1_fraud_count", "card1_tx_count", digits=4, scale=1.0).alias("fraud_share"))


# ===========================================================================
# 2.9 Data quality
# ===========================================================================
SUITE = QC.staging_suite()


def _checks_query(key: str, kind: str | None = None):
    def picked(checks):
        return [c for c in checks if kind in (None, c.kind)]

    @register(key, O.with_stage("staging", O.checks_sql(picked(O.SUITE), "staging")))
    def q(spark, sf):
        return QC.run_checks(stages(spark, sf).staging, picked(SUITE))
    q.__name__ = f"q_{key}"
    return q


_checks_query("check_row_count_between", "row_count_between")
_checks_query("check_in_set", "in_set")
_checks_query("check_not_null", "not_null")
_checks_query("check_mean_between", "mean_between")
_checks_query("check_between", "between")
_checks_query("quality_report")


@register("quality_suite", O.with_stage("staging", f"""
SELECT COUNT(*) AS total_expectations, CAST(COUNT_IF(success) AS BIGINT) AS successful_expectations,
  CAST(COUNT_IF(NOT success) AS BIGINT) AS failed_expectations,
  {O.half_away('COUNT_IF(success) * 100.0 / COUNT(*)', 2)} AS success_percent,
  COUNT_IF(NOT success) = 0 AS validation_success
FROM ({O.checks_sql(O.SUITE, 'staging')})"""))
def q_quality_suite(spark, sf):
    return QC.summarize(QC.run_checks(stages(spark, sf).staging, SUITE))


@register("quality_gate", O.with_stage("staging", f"""
SELECT * FROM ({O.checks_sql(O.SUITE, 'staging')}) WHERE NOT success AND severity = 'error'"""))
def q_quality_gate(spark, sf):
    return QC.failed_checks(QC.run_checks(stages(spark, sf).staging, SUITE))


@register("soft_check_load", O.with_stage("staging", O.checks_sql(O.SOFT, "staging")))
def q_soft_check_load(spark, sf):
    return QC.run_checks(spark.read.parquet(_staging_parquet(spark, sf)), QC.soft_load_checks())


_TESTS = {"staging_fraud": QC.SOURCE_TESTS, "stg_fraud": QC.STG_TESTS, "fraud_summary": QC.SUMMARY_TESTS,
          "fraud_hourly": QC.HOURLY_TESTS}


def _schema_tests(spark, sf, keep):
    # The tests read stored tables, as after a run: one staging table and marts.
    staging = spark.read.parquet(_staging_parquet(spark, sf))
    stg = MT.stg_fraud(staging)

    def stored(mart, name):
        path = scratch_path(spark, name)
        SK.write_parquet(mart, path)
        return spark.read.parquet(path)

    view = QC.View("staging_fraud", MT.has_value("TransactionAmt"), {b: a for a, b in STG_RENAMES})
    frames = {"staging_fraud": staging, "stg_fraud": view}
    if any(keep(t) for t in QC.SUMMARY_TESTS):
        frames["fraud_summary"] = stored(MT.fraud_summary(stg, ordered=False), "mart-summary")
    if any(keep(t) for t in QC.HOURLY_TESTS):
        frames["fraud_hourly"] = stored(MT.fraud_hourly(stg, ordered=False), "mart-hourly")
    models = {}
    for name, tests in _TESTS.items():
        picked = [t for t in tests if keep(t)]
        if picked:
            models[name] = (frames[name], picked)
    return QC.schema_tests(models)


def _schema_tests_sql(keep) -> str:
    parts = []
    for name, cte, tests in O.MODELS:
        picked = [t for t in tests if keep(t)]
        if picked:
            parts.append(O.checks_sql(picked, cte, extra=f", '{name}' AS model"))
    return O.with_stage("stg_fraud", "\nUNION ALL\n".join(parts), [SUMMARY_CTE, HOURLY_CTE])


for _key, _keep in [("test_unique", lambda t: t.kind == "unique"),
                    ("test_not_null", lambda t: t.kind == "not_null"),
                    ("test_accepted_values", lambda t: t.kind == "in_set"),
                    ("schema_test_suite", lambda t: True)]:
    def _mk(keep):
        return lambda spark, sf: _schema_tests(spark, sf, keep)
    register(_key, _schema_tests_sql(_keep))(_mk(_keep))


# ===========================================================================
# 2.10 Model
# ===========================================================================
@register("stratified_split", O.with_stage("staging", "SELECT TransactionID, isFraud, split FROM split", [SPLIT_CTE]))
def q_stratified_split(spark, sf):
    df, _ = model_frame(stages(spark, sf).staging)
    return df.select(KEY, "isFraud", "split")


@register("stratified_split_exact", O.with_stage("staging", f"""
SELECT TransactionID, isFraud,
  CASE WHEN ROW_NUMBER() OVER (PARTITION BY isFraud ORDER BY {SPLIT_U}, TransactionID)
            <= FLOOR(COUNT(*) OVER (PARTITION BY isFraud) * 0.2 + 0.5) THEN 'test' ELSE 'train' END AS split
FROM staging"""))
def q_stratified_split_exact(spark, sf):
    s = stages(spark, sf)
    return ML.stratified_split(s.staging.select(KEY, "isFraud"))


@register("hash_split", O.with_stage("staging", f"""
SELECT TransactionID, CASE WHEN {SPLIT_U} < 0.2 THEN 'test' ELSE 'train' END AS split FROM staging"""))
def q_hash_split(spark, sf):
    return ML.hash_split(stages(spark, sf).staging.select(KEY))


_STATS_SQL = ", ".join(f"AVG({c}) AS m_{i}, COALESCE(NULLIF(STDDEV_POP({c}), 0), 1.0) AS s_{i}"
                       for i, c in enumerate(O.MODEL))
_SCALED_SQL = ", ".join(O.round6(f"(f.{c} - st.m_{i}) / st.s_{i}", c) for i, c in enumerate(O.MODEL))


@register("standard_scale", O.with_stage("staging", f"""
SELECT f.TransactionID, {_SCALED_SQL}
FROM staging f, (SELECT {_STATS_SQL} FROM split WHERE split = 'train') st""", [SPLIT_CTE]))
def q_standard_scale(spark, sf):
    df, present = model_frame(stages(spark, sf).staging)
    train, _ = split_parts(df)
    scaled = ML.scale_columns(df.select(KEY, *present), ML.fit_scaler(train, present))
    return round6(scaled, *present)


@register("class_weights", O.with_stage("staging", """
SELECT isFraud, n, CAST(SUM(n) OVER () AS DOUBLE) / (COUNT(*) OVER () * n) AS weight
FROM (SELECT isFraud, COUNT(*) AS n FROM split WHERE split = 'train' GROUP BY isFraud)""", [SPLIT_CTE]))
def q_class_weights(spark, sf):
    df, _ = model_frame(stages(spark, sf).staging)
    train, _ = split_parts(df)
    return ML.class_weights(train)


@register("classification_metrics", O.with_stage("staging", f"""
SELECT tp, fp, fn, tn,
  COALESCE({O.ratio('tp + tn', 'tp + fp + fn + tn', 4, 1.0)}, 0.0) AS "accuracy",
  COALESCE({O.ratio('tp', 'tp + fp', 4, 1.0)}, 0.0) AS "precision",
  COALESCE({O.ratio('tp', 'tp + fn', 4, 1.0)}, 0.0) AS "recall",
  COALESCE({O.ratio('tp * 2', 'tp * 2 + fp + fn', 4, 1.0)}, 0.0) AS "f1"
FROM (SELECT CAST(COUNT_IF(isFraud = 1 AND is_large_tx = 1) AS BIGINT) AS tp,
             CAST(COUNT_IF(isFraud <> 1 AND is_large_tx = 1) AS BIGINT) AS fp,
             CAST(COUNT_IF(isFraud = 1 AND is_large_tx <> 1) AS BIGINT) AS fn,
             CAST(COUNT_IF(isFraud <> 1 AND is_large_tx <> 1) AS BIGINT) AS tn
      FROM staging)"""))
def q_classification_metrics(spark, sf):
    # A rule baseline (large amount = fraud) scored with the metric operator.
    scored = stages(spark, sf).staging.select("isFraud", F.col("is_large_tx").alias("prediction"))
    return ML.classification_metrics(scored)


@register("roc_auc", O.with_stage("staging", f"""
SELECT CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg,
  {O.half_away('SUM(CAST(pos AS DOUBLE) * (nb + neg * 0.5)) / NULLIF(CAST(SUM(pos) AS DOUBLE) * SUM(neg), 0.0)', 4)} AS roc_auc
FROM (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM (SELECT TransactionAmt AS s, COUNT_IF(isFraud = 1) AS pos, COUNT_IF(isFraud <> 1) AS neg
            FROM staging GROUP BY TransactionAmt))"""))
def q_roc_auc(spark, sf):
    # Amount as the score: the exact, tie-aware AUC operator on real data.
    return ML.roc_auc(stages(spark, sf).staging, score="TransactionAmt")


_VECTOR_SQL = "\nUNION ALL\n".join(
    f"SELECT TransactionID, {i} AS position, {O.half_away(f'CAST({c} AS DOUBLE)', 6)} AS value FROM staging"
    for i, c in enumerate(O.MODEL))


@register("feature_vector", O.with_stage("staging", _VECTOR_SQL))
def q_feature_vector(spark, sf):
    # The assembled matrix in coordinate form: one row per (transaction, position).
    df, present = model_frame(stages(spark, sf).staging)
    vec = ML.assembler(present).transform(df)
    return (vec.select(KEY, F.posexplode(vector_to_array("features")).alias("position", "value"))
            .withColumn("value", half_away("value", 6)))


# A model of two features, small enough for SQL to repeat: fitting is checked
# against an unrolled Newton solve, scoring with fixed coefficients.  The fit
# of all 22 features is a unit test.
_PAIR = ["TransactionAmt", "card1_tx_count"]
_FIXED = {"baseline_C1.0": ML.Coefficients(-0.3, [0.8, -0.6]), "balanced_C1.0": ML.Coefficients(0.2, [-0.5, 0.4]),
          "balanced_C0.1": ML.Coefficients(-1.0, [0.3, 0.9])}
_STANDARD_CTE = """standard AS MATERIALIZED (
  SELECT TransactionID, isFraud, split, (TransactionAmt - mean_a) / std_a AS a, (card1_tx_count - mean_b) / std_b AS b
  FROM split, (SELECT AVG(TransactionAmt) AS mean_a, STDDEV_POP(TransactionAmt) AS std_a,
                      AVG(card1_tx_count) AS mean_b, STDDEV_POP(card1_tx_count) AS std_b FROM split WHERE split = 'train'))"""


def _newton_cte(k: int) -> str:
    """One Newton step of sum(loss) + |b|^2 / 2 (C = 1), the 3 x 3 system by Cramer's rule."""
    return f"""n{k} AS MATERIALIZED (SELECT
  b0 - (g0 * (h11 * h22 - h12 * h12) - g1 * (h01 * h22 - h02 * h12) + g2 * (h01 * h12 - h02 * h11)) / det AS b0,
  b1 - (-g0 * (h01 * h22 - h12 * h02) + g1 * (h00 * h22 - h02 * h02) - g2 * (h00 * h12 - h01 * h02)) / det AS b1,
  b2 - (g0 * (h01 * h12 - h11 * h02) - g1 * (h00 * h12 - h02 * h01) + g2 * (h00 * h11 - h01 * h01)) / det AS b2
FROM (SELECT *, h00 * (h11 * h22 - h12 * h12) - h01 * (h01 * h22 - h12 * h02) + h02 * (h01 * h12 - h11 * h02) AS det
  FROM (SELECT ANY_VALUE(b0) AS b0, ANY_VALUE(b1) AS b1, ANY_VALUE(b2) AS b2,
    SUM(p - y) AS g0, SUM((p - y) * a) + ANY_VALUE(b1) AS g1, SUM((p - y) * b) + ANY_VALUE(b2) AS g2,
    SUM(w) AS h00, SUM(w * a) AS h01, SUM(w * b) AS h02,
    SUM(w * a * a) + 1 AS h11, SUM(w * a * b) AS h12, SUM(w * b * b) + 1 AS h22
    FROM (SELECT *, p * (1 - p) AS w FROM (
      SELECT a, b, isFraud AS y, b0, b1, b2, 1 / (1 + EXP(-(b0 + b1 * a + b2 * b))) AS p
      FROM standard, n{k - 1} WHERE split = 'train')))))"""


_NEWTON = [SPLIT_CTE, _STANDARD_CTE, "n0 AS (SELECT 0.0::DOUBLE AS b0, 0.0::DOUBLE AS b1, 0.0::DOUBLE AS b2)",
           *(_newton_cte(k) for k in range(1, 10))]
_COEF_SQL = "\nUNION ALL\n".join(f"SELECT '{c}' AS feature, {O.half_away(x, 4)} AS coefficient FROM n9"
                                 for c, x in (("intercept", "b0"), (_PAIR[0], "b1"), (_PAIR[1], "b2")))
_IMPORTANCE_SQL = " UNION ALL ".join(f"SELECT '{c}' AS feature, {O.half_away(f'ABS({x})', 4)} AS importance FROM n9"
                                     for c, x in zip(_PAIR, ("b1", "b2")))


def _pair_split(spark, sf):
    """(train, test) rows of the two features, stored once for the passes of the fit."""
    path = scratch_path(spark, "pair-split")
    df = ML.stratified_split(stages(spark, sf).staging.select(KEY, "isFraud", *_PAIR))
    df.write.partitionBy("split").parquet(path)
    return split_parts(spark.read.parquet(path))


def _pair_fit(spark, sf):
    train, _test = _pair_split(spark, sf)
    stats, _weights, profile = ML.training_statistics(train, _PAIR)
    return ML.logistic_pipeline(_PAIR, stats, 1.0, 200, profile["train_size"], tol=1e-12).fit(train)


def _coefficient_rows(spark, model):
    rows = [("intercept", ML.model_coefficients(model).intercept), *ML.coefficients(model, _PAIR)]
    return (spark.createDataFrame(rows, "feature STRING, coefficient DOUBLE")
            .withColumn("coefficient", half_away("coefficient", 4)))


def _importance(spark, sf):
    return (ML.feature_importance(spark, _pair_fit(spark, sf), _PAIR)
            .withColumn("importance", half_away("importance", 4)))


@register("logistic_fit", O.with_stage("staging", _COEF_SQL, _NEWTON))
def q_logistic_fit(spark, sf):
    return _coefficient_rows(spark, _pair_fit(spark, sf))


@register("feature_importance", O.with_stage("staging", _IMPORTANCE_SQL, _NEWTON))
def q_feature_importance(spark, sf):
    return _importance(spark, sf)


@register("top_k_importance", O.with_stage(
    "staging", f"SELECT * FROM ({_IMPORTANCE_SQL}) ORDER BY importance DESC, feature LIMIT 1", _NEWTON))
def q_top_k_importance(spark, sf):
    return MT.top_k(_importance(spark, sf), "importance", 1)


@register("importance_export", O.with_stage("staging", _IMPORTANCE_SQL, _NEWTON))
def q_importance_export(spark, sf):
    path = scratch_path(spark, "feature-importance-csv")
    SK.write_csv(_importance(spark, sf), path)
    return spark.read.option("header", True).schema("feature STRING, importance DOUBLE").csv(path)


@register("model_artifact", O.with_stage("staging", f"""
SELECT c.*, v AS model_version FROM ({_COEF_SQL}) c, (VALUES (1), (2)) AS versions(v)""", _NEWTON))
def q_model_artifact(spark, sf):
    # registered twice, as by two experiments: both versions are read back
    root, fitted = scratch_path(spark, "models"), _pair_fit(spark, sf)
    out = None
    for _ in range(2):
        version, _path = ML.register_model(fitted, root, "pair")
        rows = _coefficient_rows(spark, ML.load_registered(spark, root, "pair", version)) \
            .withColumn("model_version", F.lit(version))
        out = rows if out is None else out.unionByName(rows)
    return out


def _score_sql(model: ML.Coefficients) -> str:
    w1, w2 = model.weights
    return O.half_away(f"1 / (1 + EXP(-({model.intercept} + {w1} * a + {w2} * b)))", 6)


def _scored(train, test, model):
    stats, _weights, _profile = ML.training_statistics(train, _PAIR)
    out = ML.predict(model, test, _PAIR, stats, keep=[KEY, "isFraud"])
    p = half_away("probability", 6)
    return out.select(KEY, "isFraud", p.alias("probability"), (p > 0.5).cast("int").alias("prediction"))


@register("predict", O.with_stage("staging", f"""
SELECT TransactionID, isFraud, probability, CAST(probability > 0.5 AS INTEGER) AS prediction
FROM (SELECT *, {_score_sql(_FIXED['baseline_C1.0'])} AS probability FROM standard WHERE split = 'test')""",
                                 [SPLIT_CTE, _STANDARD_CTE]))
def q_predict(spark, sf):
    return _scored(*_pair_split(spark, sf), _FIXED["baseline_C1.0"])


_SCORED_CTE = "scored AS MATERIALIZED (" + " UNION ALL ".join(
    f"SELECT '{name}' AS run_name, isFraud AS y, {_score_sql(m)} AS s FROM standard WHERE split = 'test'"
    for name, m in _FIXED.items()) + ")"
_METRICS_CTE = f"""metrics AS (
SELECT run_name, UNNEST(['accuracy', 'precision', 'recall', 'f1', 'roc_auc']) AS metric,
  UNNEST([COALESCE({O.ratio('tp + tn', 'tp + fp + fn + tn', 4, 1.0)}, 0.0), COALESCE({O.ratio('tp', 'tp + fp', 4, 1.0)}, 0.0),
    COALESCE({O.ratio('tp', 'tp + fn', 4, 1.0)}, 0.0), COALESCE({O.ratio('tp * 2', 'tp * 2 + fp + fn', 4, 1.0)}, 0.0),
    roc_auc]) AS value
FROM (SELECT run_name, COUNT_IF(y = 1 AND s > 0.5) AS tp, COUNT_IF(y <> 1 AND s > 0.5) AS fp,
        COUNT_IF(y = 1 AND NOT s > 0.5) AS fn, COUNT_IF(y <> 1 AND NOT s > 0.5) AS tn FROM scored GROUP BY run_name)
JOIN (SELECT run_name, {O.half_away('SUM(CAST(pos AS DOUBLE) * (nb + neg * 0.5)) / (CAST(SUM(pos) AS DOUBLE) * SUM(neg))', 4)} AS roc_auc
      FROM (SELECT run_name, pos, neg, COALESCE(SUM(neg) OVER (PARTITION BY run_name ORDER BY s
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
            FROM (SELECT run_name, s, COUNT_IF(y = 1) AS pos, COUNT_IF(y <> 1) AS neg FROM scored GROUP BY run_name, s))
      GROUP BY run_name) USING (run_name))"""
_RUN_CTES = [SPLIT_CTE, _STANDARD_CTE, _SCORED_CTE, _METRICS_CTE]


def _logged_runs(spark, sf):
    """Three runs with fixed coefficients, evaluated together and logged to a runs table."""
    train, test = _pair_split(spark, sf)
    stats, _weights, _profile = ML.training_statistics(train, _PAIR)
    metrics = ML.evaluate_runs(test, {name: half_away(ML.probability(m, _PAIR, stats), 6)
                                      for name, m in _FIXED.items()})
    runs = [ML.RunResult(name, {"weights": m.weights}, metrics[name], None, _PAIR) for name, m in _FIXED.items()]
    path = scratch_path(spark, "runs")
    SK.write_parquet(ML.runs_frame(spark, runs), path, mode="append")
    return spark.read.parquet(path)


@register("experiment_runs", O.with_stage("staging", "SELECT * FROM metrics", _RUN_CTES))
def q_experiment_runs(spark, sf):
    return _logged_runs(spark, sf).select("run_name", F.explode("metrics").alias("metric", "value"))


@register("experiment_compare", O.with_stage("staging", "SELECT metric, " + ", ".join(
    f"MAX(CASE WHEN run_name = '{n}' THEN value END) AS \"{n}\"" for n in _FIXED) + " FROM metrics GROUP BY metric",
                                            _RUN_CTES))
def q_experiment_compare(spark, sf):
    return ML.compare_runs(_logged_runs(spark, sf), list(_FIXED))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["queries", "oracle_sql", "QUERIES", "ORACLE"]
