"""Model operators checked against brute force on small inputs."""

from __future__ import annotations

import numpy as np
import pytest
from cardlens.operators import model as ML


def _data(spark, n=400, seed=3):
    rng = np.random.default_rng(seed)
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    p = 1 / (1 + np.exp(-(0.8 * x1 - 1.2 * x2 - 1.5)))
    y = (rng.random(n) < p).astype(int)
    rows = [(i, int(y[i]), float(x1[i]), float(x2[i]), float(round(x1[i], 1))) for i in range(n)]
    return spark.createDataFrame(rows, "TransactionID BIGINT, isFraud INT, a DOUBLE, b DOUBLE, s DOUBLE"), \
        np.c_[x1, x2], y


def _newton(X, y, w, C):
    """Minimise C * sum w_i loss_i + ||beta||^2 / 2 (intercept not penalised)."""
    Xb = np.c_[X, np.ones(len(X))]
    beta = np.zeros(Xb.shape[1])
    reg = np.eye(Xb.shape[1])
    reg[-1, -1] = 0
    for _ in range(50):
        p = 1 / (1 + np.exp(-Xb @ beta))
        g = C * Xb.T @ (w * (p - y)) + reg @ beta
        H = C * (Xb.T * (w * p * (1 - p))) @ Xb + reg
        beta -= np.linalg.solve(H, g)
    return beta


def test_logistic_matches_newton_solve(spark):
    df, X, y = _data(spark)
    feats = ["a", "b"]
    stats = ML.fit_scaler(df, feats)
    Xs = (X - X.mean(0)) / X.std(0)
    for C, balanced in [(1.0, False), (0.1, True)]:
        train = df
        w = np.ones(len(y))
        wc = None
        if balanced:
            train = df.withColumn("__w", ML.weight_expression(ML.weight_values(ML.class_weights(df))))
            wc = "__w"
            w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (len(y) - y.sum())))
        model = ML.logistic_pipeline(feats, stats, C, 200, df.count(), wc).fit(train)
        got = np.array([c for _f, c in ML.coefficients(model, feats)] + [model.stages[-1].intercept])
        want = _newton(Xs, y, w, C)
        assert np.allclose(got, want, atol=1e-4), (got, want)


def test_population_std_scaling(spark):
    df, X, _y = _data(spark)
    stats = ML.fit_scaler(df, ["a"])
    assert abs(stats.std["a"] - X[:, 0].std()) < 1e-12
    out = np.array([r["a"] for r in ML.scale_columns(df.select("a"), stats).collect()])
    assert abs(out.mean()) < 1e-9 and abs(out.std() - 1) < 1e-9


def test_roc_auc_matches_pairwise_count(spark):
    df, _X, y = _data(spark)
    s = np.array([r["s"] for r in df.orderBy("TransactionID").collect()])
    pos, neg = s[y == 1], s[y == 0]
    pairs = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    want = round(pairs / (len(pos) * len(neg)), 4)
    for partitions in (1, 3, 17):
        got = ML.roc_auc(df, score="s", partitions=partitions).first()
        assert got["roc_auc"] == want and got["n_pos"] == len(pos)


def test_exact_split_counts_and_determinism(spark):
    df, _X, y = _data(spark, n=1000)
    a = ML.stratified_split(df, buckets=7)
    b = ML.stratified_split(df, buckets=2)
    per = {(r["isFraud"], r["split"]): r["count"] for r in a.groupBy("isFraud", "split").count().collect()}
    n1 = int(y.sum())
    assert per[(1, "test")] == int(np.floor(n1 * 0.2 + 0.5))
    assert per[(0, "test")] == int(np.floor((1000 - n1) * 0.2 + 0.5))
    key = ["TransactionID", "split"]
    assert sorted(a.select(key).collect()) == sorted(b.select(key).collect())


def test_hash_split_is_deterministic_and_shuffle_free(spark):
    df, _X, _y = _data(spark)
    s = ML.hash_split(df)
    assert "Exchange" not in s._jdf.queryExecution().executedPlan().toString()
    frac = s.where("split = 'test'").count() / df.count()
    assert 0.1 < frac < 0.3


def test_classification_metrics_zero_division(spark):
    df = spark.createDataFrame([(1, 0), (0, 0), (0, 0), (1, 0)], "isFraud INT, prediction INT")
    r = ML.classification_metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1"]) == (0.5, 0.0, 0.0, 0.0)


def test_experiment_compare_pivot(spark):
    from pyspark.sql import Row
    import time
    older = ML.runs_frame(spark, [ML.RunResult("r1", {}, {"f1": 0.9, "roc_auc": 0.9}, None, [])])
    time.sleep(0.01)
    runs = [ML.RunResult("r1", {"C": 1.0}, {"f1": 0.1, "roc_auc": 0.7}, None, []),
            ML.RunResult("r2", {"C": 0.1}, {"f1": 0.2, "roc_auc": 0.8}, None, [])]
    t = ML.compare_runs(ML.runs_frame(spark, runs).unionByName(older), ["r1", "r2"]).collect()
    assert t == [Row(metric="f1", r1=0.1, r2=0.2), Row(metric="roc_auc", r1=0.7, r2=0.8)]


def test_class_weights_sum_to_n(spark):
    df, _X, y = _data(spark)
    w = {r["isFraud"]: r for r in ML.class_weights(df).collect()}
    assert abs(w[0]["weight"] * w[0]["n"] + w[1]["weight"] * w[1]["n"] - len(y)) < 1e-9


def test_expression_scoring_equals_pipeline_transform(spark, tmp_path):
    df, _X, _y = _data(spark)
    feats = ["a", "b"]
    stats = ML.fit_scaler(df, feats)
    model = ML.logistic_pipeline(feats, stats, 1.0, 100, df.count()).fit(df)
    loaded = ML.load_model(ML.save_model(model, str(tmp_path / "m")))
    a = {r["TransactionID"]: r for r in ML.predict(model, df, feats, stats, keep=["TransactionID"]).collect()}
    b = {r["TransactionID"]: r for r in ML.predict_with_pipeline(loaded, df, keep=["TransactionID"]).collect()}
    assert all(a[k]["prediction"] == b[k]["prediction"] for k in a)
    assert max(abs(a[k]["probability"] - b[k]["probability"]) for k in a) < 1e-12


def test_rare_class_gets_its_share_of_the_test_part(spark):
    df = spark.range(4000).selectExpr("id AS TransactionID", "IF(id % 100 = 7, 1, 0) AS isFraud")
    got = {tuple(r) for r in ML.stratified_split(df).groupBy("isFraud", "split").count().collect()}
    assert got == {(0, "train", 3168), (0, "test", 792), (1, "train", 32), (1, "test", 8)}


# --- runs evaluated together, versions of a registered model -----------------------

def test_runs_evaluated_together_equal_single_evaluations(spark):
    import numpy as np
    from pyspark.sql import functions as F
    rng = np.random.default_rng(5)
    rows = [(int(rng.random() < 0.3), float(round(rng.random(), 2)), float(round(rng.random() ** 2, 1))) for _ in range(600)]
    df = spark.createDataFrame(rows, "isFraud INT, a DOUBLE, b DOUBLE").repartition(5)
    got = ML.evaluate_runs(df, {"a": F.col("a"), "b": F.col("b"), "const": F.lit(0.5)}, partitions=4)
    for name in ("a", "b"):
        scored = df.select("isFraud", (F.col(name) > 0.5).cast("int").alias("prediction"), F.col(name).alias("probability"))
        m = ML.classification_metrics(scored).first()
        assert got[name] == {**{k: m[k] for k in ("accuracy", "precision", "recall", "f1")},
                             "roc_auc": ML.roc_auc(scored).first()["roc_auc"]}
    assert got["const"]["roc_auc"] == 0.5 and got["const"]["precision"] == 0.0
    empty = ML.evaluate_runs(df.where("false"), {"a": F.col("a")})["a"]
    assert empty["accuracy"] == 0.0 and empty["roc_auc"] != empty["roc_auc"]


def test_runs_scan_the_test_rows_once(spark):
    from pyspark.sql import functions as F
    from cardlens.session import scratch_path
    path = scratch_path(spark, "scan-once")
    spark.range(0, 1000, 1, 3).selectExpr("CAST(id % 2 AS INT) AS isFraud", "id / 1000 AS s").write.parquet(path)
    reads = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(s):
        reads.add(1)
        return s

    test = spark.read.parquet(path).select("isFraud", counted.asNondeterministic()("s").alias("s"))
    metrics = ML.evaluate_runs(test, {f"run{k}": F.col("s") * F.lit(1.0 - k / 10) for k in range(3)})
    # range partitioning samples its input, which is the stored shuffle of the groups
    assert reads.value == 1000 and len(metrics) == 3


def _small_model(spark):
    df = spark.createDataFrame([(k % 2, float(k), float(k * k % 7)) for k in range(40)], "isFraud INT, a DOUBLE, b DOUBLE")
    return ML.train_model(df, ["a", "b"], C=1.0, max_iter=20)


def test_registered_models_get_versions(spark):
    from concurrent.futures import ThreadPoolExecutor
    from cardlens.session import scratch_path
    root, model = scratch_path(spark, "registry"), _small_model(spark)
    with pytest.raises(LookupError):
        ML.load_registered(spark, root, "m")
    assert ML.register_model(model, root, "m")[0] == 1 and ML.register_model(model, root, "m")[0] == 2
    with ThreadPoolExecutor(4) as pool:  # started together
        more = list(pool.map(lambda _: ML.register_model(model, root, "m")[0], range(4)))
    assert sorted(more) == [3, 4, 5, 6]
    want = ML.model_coefficients(model)
    for v, path in ML.model_versions(spark, root, "m").items():
        assert path.endswith(f"/{v}") and ML.model_coefficients(ML.load_registered(spark, root, "m", v)) == want
    assert ML.register_model(model, root, "other")[0] == 1
    with pytest.raises(LookupError):
        ML.load_registered(spark, root, "m", 9)


def test_failed_save_leaves_no_version(spark, monkeypatch):
    from cardlens.session import scratch_path
    root, model = scratch_path(spark, "registry"), _small_model(spark)
    with monkeypatch.context() as m:
        m.setattr(ML, "save_model", lambda *a: (_ for _ in ()).throw(OSError("disk")))
        with pytest.raises(OSError):
            ML.register_model(model, root, "m")
    assert ML.model_versions(spark, root, "m") == {}
    assert ML.register_model(model, root, "m")[0] == 2 and list(ML.model_versions(spark, root, "m")) == [2]
