"""The transform over a file stream equals the batch transform with the same
per-card snapshot."""

from __future__ import annotations

from cardlens.operators.clean import clean
from cardlens.operators.features import card_aggregates, engineer_features
from cardlens.operators.merge import merge_identity
from cardlens.session import scratch_path
from cardlens.streaming.incremental import start_featurize


def test_stream_matches_batch(spark, raw_tx, raw_identity):
    src, sink = scratch_path(spark, "stream-src"), scratch_path(spark, "stream-sink")
    raw_tx.write.parquet(src)
    snapshot = card_aggregates(clean(merge_identity(raw_tx, raw_identity)))
    q = start_featurize(spark, src, raw_identity, snapshot, sink)
    q.awaitTermination(120)
    got = spark.read.parquet(sink)
    want = engineer_features(clean(merge_identity(raw_tx, raw_identity)), snapshot)
    cols = ["TransactionID", "has_identity", "tx_hour", "card1_tx_count", "amt_deviation_from_card_mean"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())
