"""Data-quality checks: report values, one-pass plan, gate."""

from __future__ import annotations

import pytest

from cardlens.operators import quality as QC

from cardlens.operators.quality import (Check, QualityGateError, gate, run_checks, staging_suite,
                                        summarize)
from cardlens.plans.etl import transform


def report(df, checks):
    return {r["check_id"]: r for r in run_checks(df, checks).collect()}


def test_each_kind(spark):
    df = spark.createDataFrame([(1, 0, "W", 1.0), (2, 1, "X", None), (2, 5, None, 30.0)],
                               "id BIGINT, y INT, p STRING, v DOUBLE")
    r = report(df, [
        Check("row_count_between", None, {"min": 1, "max": 2}),
        Check("columns_superset", None, {"columns": ["id", "y", "zz"]}),
        Check("in_set", "y", {"values": [0, 1]}),
        Check("not_null", "v"),
        Check("mean_between", "y", {"min": 0.0, "max": 5.0}),
        Check("between", "v", {"min": 0, "max": 10}),
        Check("unique", "id"),
        Check("in_set", "p", {"values": ["W"]}),
        Check("not_in_set", "v", {"values": [30.0]}, severity="warn"),
    ])
    assert (r[1]["evaluated"], r[1]["success"]) == (3, False)
    assert (r[2]["unexpected"], r[2]["success"]) == (1, False)
    assert (r[3]["unexpected"], r[3]["success"]) == (1, False)
    assert (r[4]["unexpected"], r[4]["success"]) == (1, False)
    assert r[5]["observed"] == 2.0 and r[5]["success"]
    assert (r[6]["evaluated"], r[6]["unexpected"]) == (2, 1)      # NULL not counted
    assert (r[7]["unexpected"], r[7]["success"]) == (1, False)
    assert (r[8]["evaluated"], r[8]["unexpected"]) == (2, 1)      # NULL not counted (SQL NOT IN)
    assert r[9]["severity"] == "warn" and r[9]["unexpected"] == 1


def test_suite_on_fixture_and_gate(raw_tx, raw_identity):
    staged = transform(raw_tx, raw_identity)
    rep = run_checks(staged, staging_suite())
    s = summarize(rep).first()
    assert s["total_expectations"] == 16
    # six rows are not 500k..700k, and 2 of 6 frauds is above 10 %
    failed = {r["check"] for r in rep.where("NOT success").collect()}
    assert failed == {"row_count_between", "mean_between"}
    with pytest.raises(QualityGateError):
        gate(rep)
    ok = run_checks(staged, staging_suite(min_rows=1, max_rows=10, max_fraud_mean=0.5))
    assert gate(ok) is ok


def test_row_checks_share_one_aggregate(raw_tx, raw_identity):
    staged = transform(raw_tx, raw_identity)
    rep = run_checks(staged, [c for c in staging_suite() if c.kind != "unique"])
    plan = rep._jdf.queryExecution().optimizedPlan().toString()
    # one Aggregate over the data (the staging plan has its own per-card aggregate)
    assert plan.count("Aggregate [") <= 3


def test_uniqueness_tests_of_a_table_share_one_shuffle(spark):
    from pyspark.sql import functions as F
    from cardlens.session import scratch_path
    path = scratch_path(spark, "unique")
    rows = [(k, k // 2, "x" if k < 3 else str(k), -999.0 if k % 5 == 0 else 1.0) for k in range(20)] + [(None, 1, None, 1.0), (7, 50, "y", -999.0)]
    spark.createDataFrame(rows, "k BIGINT, h INT, s STRING, amt DOUBLE").write.parquet(path)
    df = spark.read.parquet(path)
    view = QC.View("t", F.col("amt") != -999, {"id": "k", "half": "h", "v": "amt"})
    models = {"t": (df, [QC.Check("unique", "k"), QC.Check("unique", "h"), QC.Check("not_null", "k"), QC.Check("unique", "s")]),
              "v": (view, [QC.Check("unique", "id"), QC.Check("unique", "half"), QC.Check("not_null", "id"),
                           QC.Check("in_set", "v", {"values": [1]}), QC.Check("row_count_between", None, {"min": 17, "max": 17}),
                           QC.Check("columns_superset", None, {"columns": ["id", "amt"]})])}
    rep = QC.schema_tests(models)
    shown = df.where(view.where).selectExpr("k AS id", "h AS half", "amt AS v")
    apart = QC.run_checks(df, models["t"][1]).selectExpr("*", "'t' AS model").unionByName(
        QC.run_checks(shown, models["v"][1]).selectExpr("*", "'v' AS model"))
    key = lambda r: (r.model, r.check_id)
    assert sorted(rep.collect(), key=key) == sorted(apart.collect(), key=key)
    uniques = QC.schema_tests({m: (d, [c for c in checks if c.kind == "unique"]) for m, (d, checks) in models.items()})
    plan = uniques._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and plan.count("FileScan") == 1
    with pytest.raises(ValueError, match="nowhere"):
        QC.schema_tests({"v": (QC.View("nowhere", F.lit(True), {}), [])})
