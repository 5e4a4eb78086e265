"""Modelling: features, split, scaling, weighted logistic regression,
metrics, experiment runs (P14, P15, M1-M12).

Everything stays distributed: statistics are aggregates (one row per
feature or class reaches the driver), the solver is Spark ML's L-BFGS whose
gradient is a ``treeAggregate`` over the executors, and metrics are one
aggregate over the scored test rows.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.rounding import half_away, ratio
from ..schemas import KEY, LABEL, MODEL_FEATURES, NUMERIC_SENTINEL
from ..session import list_folder, put_if_absent
from .ranking import bucket_count, fraction_bucket, running_sum, with_range_bucket

# ---------------------------------------------------------------------------
# Feature matrix
# ---------------------------------------------------------------------------


def select_features(df: DataFrame, features: list[str] = MODEL_FEATURES) -> tuple[list[str], list[str]]:
    """(present, missing) feature names; the caller reports the missing ones."""
    present = [c for c in features if c in df.columns]
    return present, [c for c in features if c not in df.columns]


def fill_features(df: DataFrame, features: list[str], value=NUMERIC_SENTINEL) -> DataFrame:
    """Remaining NULLs in the feature columns to ``value``."""
    return df.na.fill(value, subset=features)


def assembler(features: list[str], output: str = "features") -> VectorAssembler:
    """Feature columns to one vector column; NULL or NaN is an error (M1)."""
    return VectorAssembler(inputCols=features, outputCol=output, handleInvalid="error")


# ---------------------------------------------------------------------------
# Split (M2)
# ---------------------------------------------------------------------------


def split_hash(key: str = KEY, seed: int = 42) -> Column:
    """A deterministic number in [0, 1) per key: the first 32 bits of
    ``md5('<seed>:<key>')``.  md5 is used so any SQL engine can repeat it."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def hash_split(df: DataFrame, key: str = KEY, test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split`` = 'train' / 'test' by a hash threshold per row: no
    shuffle, but class proportions hold in expectation only."""
    return df.withColumn("split", F.when(split_hash(key, seed) < F.lit(test_fraction), "test").otherwise("train"))


def stratified_split(df: DataFrame, label: str = LABEL, key: str = KEY,
                     test_fraction: float = 0.2, seed: int = 42,
                     buckets: int | None = None) -> DataFrame:
    """Add ``split`` = 'train' / 'test', keeping class proportions exactly.

    Per class, the ``round(test_fraction * n)`` rows with the smallest hash go
    to test.  The rank inside each class is a distributed running count over
    hash-fraction buckets (``ranking.running_sum``), not a window over the
    whole class, so the majority class is not funnelled into one task.
    """
    u = split_hash(key, seed)
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("__n"))
    quota = counts.select(label, F.floor(F.col("__n") * F.lit(test_fraction) + F.lit(0.5)).alias("__quota"))
    if buckets is None:
        # About a million rows per bucket; the bucket totals stay a small table.
        buckets = bucket_count(counts.agg(F.max("__n")).first()[0] or 0)
    base = df.withColumn("__u", u).withColumn("__one", F.lit(1))
    ranked = running_sum(base, ["__u", key], "__one", "__rank",
                         bucket=fraction_bucket(F.col("__u"), buckets), by=[label])
    # One row per class: a proven-small broadcast.
    return (ranked.join(F.broadcast(quota), on=label, how="left")
            .withColumn("split", F.when(F.col("__rank") <= F.col("__quota"), "test").otherwise("train"))
            .drop("__u", "__one", "__rank", "__quota"))


# ---------------------------------------------------------------------------
# Class weights (M4) and scaling (M3)
# ---------------------------------------------------------------------------


def class_weights(df: DataFrame, label: str = LABEL) -> DataFrame:
    """``balanced`` weights: n / (classes * n_class), one row per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    # One row per class, so the empty window is a handful of rows.
    total = F.sum("n").over(Window.partitionBy())
    k = F.count(F.lit(1)).over(Window.partitionBy())
    return counts.select(label, "n", (total.cast("double") / (k * F.col("n"))).alias("weight"))


def weight_values(weights: DataFrame, label: str = LABEL) -> dict:
    """{class: weight}; one row per class reaches the driver."""
    return {r[label]: float(r["weight"]) for r in weights.collect()}


def weight_expression(values: dict, label: str = LABEL) -> Column:
    """The per-class weight as a CASE expression (no join)."""
    expr = None
    for cls, w in sorted(values.items()):
        expr = (F.when(F.col(label) == F.lit(cls), F.lit(w)) if expr is None
                else expr.when(F.col(label) == F.lit(cls), F.lit(w)))
    return expr.otherwise(F.lit(None).cast("double"))


@dataclass
class ScalerStats:
    mean: dict
    std: dict


def fit_scaler(df: DataFrame, features: list[str]) -> ScalerStats:
    """Mean and population standard deviation per feature: one aggregate,
    one row (2 x features numbers) to the driver."""
    row = df.agg(*[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                 *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)]).first()
    return ScalerStats({c: row[f"m_{i}"] for i, c in enumerate(features)},
                       {c: row[f"s_{i}"] for i, c in enumerate(features)})


def scaler_transformer(stats: ScalerStats) -> SQLTransformer:
    """The fitted scaling as a pipeline stage: ``(x - mean) / std``; a
    constant column (std 0) is only centred.  Saved with the model."""
    cols = []
    for c, m in stats.mean.items():
        s = stats.std[c] or 1.0
        cols.append(f"(`{c}` - {float(m or 0.0)!r}D) / {float(s)!r}D AS `{c}`")
    scaled = ", ".join(c.replace(" AS `", " AS `__scaled_") for c in cols)
    return SQLTransformer(statement=f"SELECT *, {scaled} FROM __THIS__")


def scale_columns(df: DataFrame, stats: ScalerStats) -> DataFrame:
    """Apply the scaling as plain column expressions (M3)."""
    return df.select(*[
        ((F.col(c) - F.lit(float(stats.mean[c] or 0.0))) / F.lit(float(stats.std[c] or 1.0))).alias(c)
        if c in stats.mean else F.col(c) for c in df.columns])


# ---------------------------------------------------------------------------
# Logistic regression
# ---------------------------------------------------------------------------


def logistic_pipeline(features: list[str], stats: ScalerStats, C: float, max_iter: int,
                      n_train: int, weight_col: str | None = None, label: str = LABEL,
                      tol: float = 1e-6) -> Pipeline:
    """scale -> assemble -> L2 logistic regression.

    ``C`` is the inverse penalty of ``C * sum_i w_i loss_i + ||b||^2 / 2``.
    Spark minimises ``(1/sum w) sum_i w_i loss_i + regParam * ||b||^2 / 2``,
    the same optimum when ``regParam = 1 / (C * sum w)``; balanced weights
    sum to n, so ``regParam = 1 / (C * n_train)`` in both cases.
    """
    scaled = [f"__scaled_{c}" for c in features]
    lr = LogisticRegression(featuresCol="features", labelCol=label,
                            regParam=1.0 / (C * n_train), elasticNetParam=0.0,
                            standardization=False, fitIntercept=True, maxIter=max_iter,
                            tol=tol, family="binomial")
    if weight_col:
        lr.setWeightCol(weight_col)
    return Pipeline(stages=[scaler_transformer(stats), assembler(scaled), lr])


@dataclass
class Coefficients:
    """A logistic model as numbers: an intercept and one weight per scaled feature."""

    intercept: float
    weights: list


def model_coefficients(model: PipelineModel | Coefficients) -> Coefficients:
    if isinstance(model, Coefficients):
        return model
    lr = model.stages[-1]
    return Coefficients(float(lr.intercept), [float(x) for x in lr.coefficients.toArray()])


def linear_margin(model: PipelineModel | Coefficients, features: list[str], stats: ScalerStats) -> Column:
    """``intercept + sum_i w_i * (x_i - mean_i) / std_i`` as one column expression."""
    known = model_coefficients(model)
    margin = F.lit(known.intercept)
    for c, w in zip(features, known.weights):
        scaled = (F.col(c) - F.lit(float(stats.mean[c] or 0.0))) / F.lit(float(stats.std[c] or 1.0))
        margin = margin + F.lit(float(w)) * scaled
    return margin


def probability(model: PipelineModel | Coefficients, features: list[str], stats: ScalerStats) -> Column:
    """Probability of class 1 as one column expression."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-linear_margin(model, features, stats)))


def predict(model: PipelineModel | Coefficients, df: DataFrame, features: list[str], stats: ScalerStats,
            keep: list[str] | None = None, threshold: float = 0.5) -> DataFrame:
    """Class and probability of class 1 per row (M6).

    Scored with a plain expression of the fitted coefficients, the same
    numbers ``model.transform`` computes (``1 / (1 + exp(-margin))``, class
    1 above the threshold).  The expression stays in whole-stage codegen and
    ships no model object to the executors.
    """
    p = probability(model, features, stats)
    return df.select(*(keep or []), (p > F.lit(threshold)).cast("int").alias("prediction"),
                     p.alias("probability"))


def predict_with_pipeline(model: PipelineModel, df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """The same through ``model.transform`` (vector UDFs), for a loaded pipeline."""
    out = model.transform(df)
    return out.select(*(keep or []), F.col("prediction").cast("int").alias("prediction"),
                      vector_to_array("probability")[1].alias("probability"))


def coefficients(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    return list(zip(features, model_coefficients(model).weights))


def feature_importance(spark: SparkSession, model: PipelineModel, features: list[str]) -> DataFrame:
    """|coefficient| per feature, largest first (M9).  Model-sized: one row
    per feature, built from the fitted coefficients."""
    rows = [(f, abs(c)) for f, c in coefficients(model, features)]
    return spark.createDataFrame(rows, "feature STRING, importance DOUBLE") \
        .orderBy(F.desc("importance"), "feature")


# ---------------------------------------------------------------------------
# Metrics (M7, M8)
# ---------------------------------------------------------------------------


def classification_metrics(scored: DataFrame, label: str = LABEL,
                           prediction: str = "prediction") -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, 4 dp, 0 on an empty
    denominator: one aggregate of the confusion counts."""
    y, p = F.col(label) == 1, F.col(prediction) == 1
    c = scored.agg(F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
                   F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))

    def r(num, den):
        return F.coalesce(ratio(num, den, digits=4, scale=1.0), F.lit(0.0))

    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select("tp", "fp", "fn", "tn",
                    r(tp + tn, tp + fp + fn + tn).alias("accuracy"),
                    r(tp, tp + fp).alias("precision"),
                    r(tp, tp + fn).alias("recall"),
                    r(tp * 2, tp * 2 + fp + fn).alias("f1"))


def roc_auc(scored: DataFrame, label: str = LABEL, score: str = "probability",
            digits: int = 4, partitions: int | None = None) -> DataFrame:
    """Exact area under the ROC curve, ties counted one half.

    Rows are first reduced to one row per distinct score (partial
    aggregation), stored once in ranges of the score; each score then needs
    the number of negatives below it: the totals of the lower ranges plus a
    running sum inside its own.  No single-task sort, no approximation.
    """
    g = scored.groupBy(F.col(score).cast("double").alias("__s")).agg(
        F.count_if(F.col(label) == 1).alias("__pos"), F.count_if(F.col(label) != 1).alias("__neg"))
    g = with_range_bucket(g, "__s", "__b", partitions)
    below = running_sum(g, ["__s"], "__neg", "__neg_below", bucket="__b", inclusive=False)
    agg = below.agg(
        F.sum(F.col("__pos").cast("double") * (F.col("__neg_below") + F.col("__neg") * F.lit(0.5))).alias("__num"),
        F.sum("__pos").cast("long").alias("n_pos"), F.sum("__neg").cast("long").alias("n_neg"))
    auc = F.col("__num") / F.nullif(F.col("n_pos").cast("double") * F.col("n_neg"), F.lit(0.0))
    return agg.select("n_pos", "n_neg", half_away(auc, digits).alias("roc_auc"))


def evaluate_runs(test: DataFrame, scores: dict[str, Column], label: str = LABEL, threshold: float = 0.5,
                  partitions: int | None = None) -> dict[str, dict]:
    """Accuracy, precision, recall, F1 and exact AUC of several score columns,
    and the number of rows, from one pass over ``test``.

    Every row gives one (run, score) pair per run; the pairs are counted by
    class map-side and stored once in ranges of (run, score).  All metrics
    follow from those counts: the confusion counts by the threshold, the AUC
    from running sums per run.  One row per run reaches the driver."""
    each = F.array(*[F.struct(F.lit(name).alias("run_name"), s.cast("double").alias("__s"))
                     for name, s in scores.items()])
    groups = (test.select(F.col(label).alias("__y"), F.explode(each).alias("__r"))
              .groupBy("__r.run_name", "__r.__s")
              .agg(F.count_if(F.col("__y") == 1).alias("__pos"), F.count_if(F.col("__y") != 1).alias("__neg")))
    groups = with_range_bucket(groups, ["run_name", "__s"], "__b", partitions)
    below = running_sum(groups, ["__s"], "__neg", "__neg_below", bucket="__b", by=["run_name"], inclusive=False)
    above, pos, neg = F.col("__s") > F.lit(threshold), F.col("__pos"), F.col("__neg")

    def total(counted, cond=None):
        return F.coalesce(F.sum(counted if cond is None else F.when(cond, counted)), F.lit(0)).cast("long")

    counts = below.groupBy("run_name").agg(
        total(pos, above).alias("tp"), total(neg, above).alias("fp"), total(pos).alias("n_pos"),
        total(neg).alias("n_neg"),
        F.sum(pos.cast("double") * (F.col("__neg_below") + neg * F.lit(0.5))).alias("__num"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("n_pos") - F.col("tp")
    right = tp + F.col("n_neg") - fp

    def rate(num, den):
        return F.coalesce(ratio(num, den, digits=4, scale=1.0), F.lit(0.0))

    auc = F.col("__num") / F.nullif(F.col("n_pos").cast("double") * F.col("n_neg"), F.lit(0.0))
    rows = counts.select("run_name", (F.col("n_pos") + F.col("n_neg")).alias("n"),
                         rate(right, F.col("n_pos") + F.col("n_neg")).alias("accuracy"),
                         rate(tp, tp + fp).alias("precision"), rate(tp, tp + fn).alias("recall"),
                         rate(tp * 2, tp * 2 + fp + fn).alias("f1"), half_away(auc, 4).alias("roc_auc")).collect()
    found = {r["run_name"]: r for r in rows}
    empty = {"accuracy": 0.0, "precision": 0.0, "recall": 0.0, "f1": 0.0, "roc_auc": None}
    return {name: {k: float("nan") if (v := found[name][k] if name in found else empty[k]) is None else float(v)
                   for k in empty} for name in scores}


# ---------------------------------------------------------------------------
# Experiments
# ---------------------------------------------------------------------------

RUNS_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()),
    T.StructField("logged_at", T.TimestampType()),
    T.StructField("run_name", T.StringType()),
    T.StructField("params", T.MapType(T.StringType(), T.StringType())),
    T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
    T.StructField("model_version", T.IntegerType()),
    T.StructField("model_path", T.StringType()),
])

# The three configurations compared by the experiment.
DEFAULT_CONFIGS = [
    ("baseline_C1.0", {"C": 1.0, "max_iter": 100, "class_weight": None}),
    ("balanced_C1.0", {"C": 1.0, "max_iter": 200, "class_weight": "balanced"}),
    ("balanced_C0.1", {"C": 0.1, "max_iter": 200, "class_weight": "balanced"}),
]


@dataclass
class RunResult:
    run_name: str
    params: dict
    metrics: dict
    model: PipelineModel
    features: list
    stats: ScalerStats | None = None
    version: int | None = None
    model_path: str | None = None


def train_model(train: DataFrame, features: list[str], C: float, max_iter: int, class_weight: str | None = None,
                n_train: int | None = None, stats: ScalerStats | None = None, label: str = LABEL,
                weights: dict | None = None) -> PipelineModel:
    """Fit one configuration on ``train`` (M5); ``weights`` are used by
    ``class_weight="balanced"``."""
    n_train = n_train if n_train is not None else train.count()
    stats = stats or fit_scaler(train, features)
    weight_col = None
    if class_weight == "balanced":
        values = weights or weight_values(class_weights(train, label), label)
        train = train.withColumn("__w", weight_expression(values, label))
        weight_col = "__w"
    return logistic_pipeline(features, stats, C, max_iter, n_train, weight_col, label).fit(train)


def training_statistics(train: DataFrame, features: list[str], label: str = LABEL
                        ) -> tuple[ScalerStats, dict, dict]:
    """One aggregate pass over the training rows: feature means and
    population deviations (scaler), ``balanced`` weights of the two classes,
    and the size and class prior (4 dp) logged with each run (A19).
    The label is 0/1."""
    row = train.agg(F.count(F.lit(1)).alias("n"), F.sum(label).alias("pos"),
                    *[F.avg(c).alias(f"m_{i}") for i, c in enumerate(features)],
                    *[F.stddev_pop(c).alias(f"s_{i}") for i, c in enumerate(features)]).first()
    stats = ScalerStats({c: row[f"m_{i}"] for i, c in enumerate(features)},
                        {c: row[f"s_{i}"] for i, c in enumerate(features)})
    n, pos = int(row["n"]), int(row["pos"] or 0)
    weights = {1: n / (2 * pos), 0: n / (2 * (n - pos))} if 0 < pos < n else {}
    prior = math.floor(pos * 10000.0 / n + 0.5) / 10000.0 if n else None
    return stats, weights, {"train_size": n, "fraud_rate_train": prior}


def run_experiments(train: DataFrame, test: DataFrame, features: list[str], configs=None,
                    parallelism: int | None = None, cache: bool = False, label: str = LABEL,
                    extra_params: dict | None = None) -> list[RunResult]:
    """Fit every configuration, then evaluate all of them in one pass over the
    test rows; results in configuration order.

    Spark's logistic regression caches its own blocks of training instances
    for the iterations; the scaler, class weights and sizes come from one
    aggregate pass.  Fits are independent, and ``parallelism`` of them
    (default: all) are submitted at once from driver threads; each holds a
    block cache of its own, so give 1 where three copies would not fit.
    ``cache`` also keeps the training rows for the fits, which saves reading
    the source once per fit where they are small.
    """
    from concurrent.futures import ThreadPoolExecutor

    configs = configs or DEFAULT_CONFIGS
    stats, weights, profile = training_statistics(train, features, label)
    rows = train.persist() if cache else train

    def fit(item):
        return train_model(rows, features, n_train=profile["train_size"], stats=stats, label=label,
                           weights=weights or None, **item[1])

    try:
        with ThreadPoolExecutor(max_workers=max(1, min(parallelism or len(configs), len(configs)))) as pool:
            models = list(pool.map(fit, configs))
    finally:
        if cache:
            rows.unpersist()
    size = Observation("test")
    metrics = evaluate_runs(test.observe(size, F.count(F.lit(1)).alias("n")),
                            {name: probability(m, features, stats) for (name, _), m in zip(configs, models)}, label)
    extra = {**profile, "test_size": int(size.get["n"]), **(extra_params or {})}
    return [RunResult(name, {"model": "LogisticRegression", **cfg, "features_count": len(features), **extra},
                      metrics[name], model, features, stats) for (name, cfg), model in zip(configs, models)]


def runs_frame(spark: SparkSession, runs: list[RunResult]) -> DataFrame:
    """One row per run: id, time, name, params (text map), metrics (double map)
    and the registered model (M10).  Runs logged together share the id."""
    run_id, now = uuid.uuid4().hex, datetime.now(timezone.utc)
    rows = [(run_id, now, r.run_name, {k: str(v) for k, v in r.params.items()}, r.metrics, r.version,
             r.model_path) for r in runs]
    return spark.createDataFrame(rows, RUNS_SCHEMA)


def compare_runs(runs: DataFrame, run_names: list[str]) -> DataFrame:
    """metric x run table (M11); of several runs of a name the one logged last counts."""
    return (runs.select("run_name", "logged_at", "run_id", F.explode("metrics").alias("metric", "value"))
            .groupBy("metric").pivot("run_name", run_names)
            .agg(F.max_by("value", F.struct("logged_at", "run_id")))
            .orderBy("metric"))


def save_model(model: PipelineModel, path: str) -> str:
    """Persist the fitted pipeline (scaling included)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def claim_version(spark: SparkSession, root: str, name: str) -> int:
    """The next version number of ``name`` below ``root``, for the caller alone.

    It is claimed by creating its file where none is: one winner, also among
    jobs that start together."""
    folder = f"{root.rstrip('/')}/{name}/claims"
    version = 1 + max((int(n) for n, _ in list_folder(spark, folder) if n.isdigit()), default=0)
    while not put_if_absent(spark, f"{folder}/{version}"):
        version += 1
    return version


def register_model(model: PipelineModel, root: str, name: str, version: int | None = None) -> tuple[int, str]:
    """Save ``model`` as a version of ``name`` below ``root`` (default: the next
    one); returns (version, path) (M12).

    Numbers are claimed, so no version is ever overwritten.  A version counts
    from the moment its mark is written, after the model; the number of a save
    that failed stays unused."""
    spark = SparkSession.active()
    version = version or claim_version(spark, root, name)
    folder = f"{root.rstrip('/')}/{name}"
    path = save_model(model, f"{folder}/versions/{version}")
    put_if_absent(spark, f"{folder}/complete/{version}")
    return version, path


def model_versions(spark: SparkSession, root: str, name: str) -> dict[int, str]:
    """{version: path} of the complete versions of ``name``."""
    folder = f"{root.rstrip('/')}/{name}"
    found = sorted(int(n) for n, _ in list_folder(spark, f"{folder}/complete") if n.isdigit())
    return {v: f"{folder}/versions/{v}" for v in found}


def load_registered(spark: SparkSession, root: str, name: str, version: int | None = None) -> PipelineModel:
    """A version of a registered model, by default the latest complete one."""
    known = model_versions(spark, root, name)
    if not known or (version is not None and version not in known):
        raise LookupError(f"{name}: version {version or 'any'} is not registered below {root}")
    return load_model(known[version if version is not None else max(known)])
