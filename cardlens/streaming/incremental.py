"""The transform applied to transaction files as they arrive.

The reference runs batch only.  Its row-level operators (merge, sentinels,
time/amount features) are stateless, so the same functions accept a
streaming DataFrame: new transaction files are merged with the stored
identity table and the stored per-card statistics (stream-static left
joins) and appended to a Parquet sink.  The per-card statistics are the
snapshot of the last batch run (``operators.features.card_aggregates``
written with ``sources.sinks.write_parquet``); a batch rerun refreshes them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean
from ..operators.features import engineer_features
from ..operators.merge import merge_identity
from ..schemas import TRANSACTION_SCHEMA
from ..session import scratch_path


def featurize_stream(spark: SparkSession, transactions_dir: str, identity: DataFrame,
                     card_aggregates: DataFrame, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming 71-column feature rows for Parquet transaction files."""
    reader = spark.readStream.schema(TRANSACTION_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    stream = reader.parquet(transactions_dir)
    return engineer_features(clean(merge_identity(stream, identity)), card_aggregates)


def start_featurize(spark: SparkSession, transactions_dir: str, identity: DataFrame,
                    card_aggregates: DataFrame, sink: str, checkpoint: str | None = None,
                    available_now: bool = True) -> StreamingQuery:
    """Append feature rows to ``sink``.  The checkpoint (default: a folder
    below the shared ``spark.checkpoint.dir``) makes restarts resume
    exactly where they stopped."""
    df = featurize_stream(spark, transactions_dir, identity, card_aggregates)
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("path", sink)
         .option("checkpointLocation", checkpoint or scratch_path(spark, "featurize-stream-ckpt")))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
