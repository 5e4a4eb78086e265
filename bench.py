"""Benchmark of the headline stages; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Stages mirror the reference's timed steps: extract (CSV -> Parquet),
transform (merge + clean + features -> Parquet), validate (16 checks),
marts (staging view + two marts), load read-back, schema tests, and the
three model runs.  Each stage is timed end to end including its action;
result sets that are data-sized are written (Parquet or the ``noop`` sink),
never collected.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cardlens.operators import marts as MT  # noqa: E402
from cardlens.operators import profiles as PR  # noqa: E402
from cardlens.operators import quality as QC  # noqa: E402
from cardlens.plans.etl import experiments, mart_tests, transform  # noqa: E402
from cardlens.plans.stages import stages  # noqa: E402
from cardlens.schemas import RAW_IDENTITY_SCHEMA, RAW_TRANSACTION_SCHEMA  # noqa: E402
from cardlens.session import build_session, scratch_path  # noqa: E402
from cardlens.sources import files as FS  # noqa: E402
from cardlens.sources.adapter import load_sources  # noqa: E402
from cardlens.sources import sinks as SK  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    # BENCH_EVENT_LOG=<folder> keeps Spark's event log for stage/task times.
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus),
                          extra={"spark.driver.memory": "16g"},
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG") or None)
    times: dict[str, float] = {}

    def timed(name, fn):
        t = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t, 3)
        return out

    s = stages(spark, sf_dir)
    # Untimed: the CSV inputs of the extract stage, derived from events.
    tx_csv, idn_csv = scratch_path(spark, "bench-tx-csv"), scratch_path(spark, "bench-idn-csv")
    s.tx.repartition(cpus).write.mode("overwrite").option("header", True).csv(tx_csv)
    s.idn.repartition(cpus).write.mode("overwrite").option("header", True).csv(idn_csv)
    spark.read.parquet(f"{sf_dir}/events.parquet").count()          # JVM / reader warm-up

    tx_pq, idn_pq = scratch_path(spark, "bench-raw-tx"), scratch_path(spark, "bench-raw-idn")

    def extract():
        tx, c1 = FS.ingest_csv(spark, tx_csv, tx_pq, RAW_TRANSACTION_SCHEMA)
        idn, c2 = FS.ingest_csv(spark, idn_csv, idn_pq, RAW_IDENTITY_SCHEMA, bool_columns=[])
        PR.transaction_summary(tx).collect()
        PR.identity_summary(idn).collect()
        return tx, idn
    tx, idn = timed("extract_csv_to_parquet", extract)

    root = scratch_path(spark, "bench")
    staging_pq = f"{root}/staging_fraud"
    timed("transform_features_to_parquet",
          lambda: SK.write_parquet(transform(tx, idn), staging_pq))
    staged = spark.read.parquet(staging_pq)

    timed("validate_16_checks", lambda: QC.run_checks(staged, QC.staging_suite()).collect())

    def marts():
        stg = MT.stg_fraud(staged)
        stg.createOrReplaceTempView("stg_fraud")
        SK.write_parquet(MT.fraud_summary(stg, ordered=False), scratch_path(spark, "bench-summary"))
        SK.write_parquet(MT.fraud_hourly(stg), scratch_path(spark, "bench-hourly"))
    timed("marts", marts)

    def load():
        SK.warehouse_load(spark, staging_pq, "bench_staging_fraud", path=scratch_path(spark, "bench-warehouse")).first()
        PR.load_readback(spark.table("bench_staging_fraud")).collect()
    timed("warehouse_load_and_readback", load)

    def schema_tests():
        stg = MT.stg_fraud(staged)
        mart_tests(staged, MT.fraud_summary(stg, ordered=False), MT.fraud_hourly(stg, ordered=False)).collect()
    timed("schema_tests_17", schema_tests)

    def features():  # statistics job included
        fresh_tx, fresh_idn = load_sources(spark, sf_dir)
        transform(fresh_tx, fresh_idn).write.format("noop").mode("overwrite").save()
    timed("features_from_events_noop", features)

    def models():
        return experiments(spark, root, cache=True)["runs"]
    metrics = timed("model_3_runs", models)

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_total_sec", "value": total, "unit": "sec",
                      "queries": times, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus,
                      "model_metrics": metrics}))
    spark.stop()


if __name__ == "__main__":
    main()
