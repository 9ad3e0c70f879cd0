"""MLlib models (M-1 ... M-10).

Three families with the reference's hyper-parameters, translated to MLlib:

* LR  - L2 logistic regression, C = 1, balanced class weights. sklearn sums the
  weighted loss, MLlib averages it, so ``regParam = 1 / (C * sum(w))``;
  features are already standardised, so ``standardization=False``.
* RF  - 300 trees, depth 8, >= 20 rows per node, sqrt features, balanced. Each
  row keeps its node of every tree from level to level (the same trees, without
  a walk down from each root).
* GBT - 300 rounds, depth 4, step 0.05, row sample 0.8, feature sample 0.8
  (per node in MLlib), positives weighted neg / pos. MLlib's first-order
  boosting stands in for the xgboost model (compare quality, not values).

Beyond ``BINNED_ROWS`` training rows the same trees grow on binned blocks of rows
(:mod:`cadence.operators.trees`), boosted models together (:func:`fit_together`).
Weights, predictions and metrics stay DataFrames; only model facts
(importances, coefficients: one number per feature) come to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.config import ModelParams
from cadence.operators import trees

ALGOS = ("LR", "RF", "GBT")
LOADERS = {"LR": LogisticRegressionModel, "RF": RandomForestClassificationModel, "GBT": GBTClassificationModel}


def _weights(y: Column, n: Column, p: Column) -> dict[str, Column]:
    wb = F.when(y == 1, n / (2.0 * p)).otherwise(n / (2.0 * (n - p)))
    spw = F.when(p > 0, (n - p) / p).otherwise(F.lit(1.0))
    return {"w_balanced": wb.cast("double"), "w_pos": F.when(y == 1, spw).otherwise(F.lit(1.0)).cast("double")}


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """M-4: ``w_balanced`` = n / (2 n_class); ``w_pos`` = neg / pos on
    positives (1.0 when there are no positives), 1 on negatives."""
    y = F.col(label).cast("long")
    c = df.agg(F.count(F.lit(1)).alias("_n"), F.sum(y).alias("_p"))
    return df.crossJoin(F.broadcast(c)).withColumns(_weights(y, F.col("_n"), F.col("_p"))).drop("_n", "_p")


def estimator(algo: str, params: ModelParams, n_weight: float, label: str = "label",
              features: str = "features"):
    """M-1 / M-2 / M-3 estimator for ``algo`` (``n_weight`` = sum of weights)."""
    if algo == "LR":
        return LogisticRegression(
            featuresCol=features, labelCol=label, weightCol="w_balanced",
            maxIter=params.lr_max_iter, regParam=1.0 / (params.lr_c * max(n_weight, 1.0)),
            elasticNetParam=0.0, standardization=False, tol=1e-6)
    if algo == "RF":
        return RandomForestClassifier(
            featuresCol=features, labelCol=label, weightCol="w_balanced",
            numTrees=params.rf_trees, maxDepth=params.rf_depth,
            minInstancesPerNode=params.rf_min_leaf, featureSubsetStrategy="sqrt",
            cacheNodeIds=True, seed=params.seed)
    if algo == "GBT":
        return GBTClassifier(
            featuresCol=features, labelCol=label, weightCol="w_pos",
            maxIter=params.gbt_rounds, maxDepth=params.gbt_depth, stepSize=params.gbt_step,
            subsamplingRate=params.gbt_subsample,
            featureSubsetStrategy=str(params.gbt_colsample), seed=params.seed)
    raise ValueError(f"unknown algorithm {algo!r}")


def positive_score(pred: DataFrame, key: str = "customer_id", label: str = "label",
                   also: Sequence[str] = ()) -> DataFrame:
    """(key, label, score, margin): P(class 1) and the raw margin."""
    return pred.select(key, *also, F.col(label).cast("int").alias("label"),
                       vector_to_array("probability")[1].alias("score"),
                       vector_to_array("rawPrediction")[1].alias("margin"))


@dataclass
class Fitted:
    setup: str
    algo: str
    model: object
    names: list[str]


#: Training rows per task and tree.
TASK_ROWS = 20_000
#: The same for boosted trees. Every level is a job of its own, whose tasks cost
#: more than their work when they hold few rows, and several chains share the cores.
BOOSTED_ROWS = 100_000
#: Cores that forests leave to the boosted models fitted beside them (four in both
#: grids): the short jobs of those chains would wait for the long tasks of a level.
#: The same for every grid, so that a forest does not depend on who fits it.
SPARED = 4
#: Beyond so many training rows trees are grown on binned blocks of rows
#: (:mod:`cadence.operators.trees`); below, jobs cost more than rows do.
BINNED_ROWS = 100_000


def dealt(train: DataFrame, n: int, trees: int = 1, rows: int = TASK_ROWS, spared: int = 0) -> DataFrame:
    """``n`` training rows in as many tasks as their work for ``trees`` trees at
    once asks for (``rows`` a task and tree), but no more than cores: each sends
    the statistics of all open nodes of a level, which would grow with the
    partitions of the input. No row is shuffled. ``spared`` cores, at most half,
    stay free, unless the rows are few, or so many that a boosted model has a
    task for every core itself."""
    cores = train.sparkSession.sparkContext.defaultParallelism
    if TASK_ROWS < n <= BOOSTED_ROWS * (cores - 1):
        cores -= min(spared, cores // 2)
    return train.coalesce(max(1, min(-(-n * trees // rows), cores)))


def _ready(train: DataFrame, algo: str, params: ModelParams, label: str):
    """(estimator, weighted rows, class weights); the last is None if MLlib fits the rows."""
    y = F.col(label).cast("long")
    r = train.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(y), F.lit(0)).alias("p")).first()
    n, p = r["n"], r["p"]
    total = n / 2 * ((p > 0) + (p < n))  # the sum of w_balanced
    rows = dealt(train, n, params.rf_trees if algo == "RF" else 1, BOOSTED_ROWS if algo == "GBT" else TASK_ROWS,
                 SPARED if algo == "RF" else 0)
    weighted = rows.withColumns(_weights(y, F.lit(float(n)), F.lit(float(p))))
    made = estimator(algo, params, float(total) or 1.0, label)
    if algo == "LR" or not (n > BINNED_ROWS and 0 < p < n) or not trees.supported(made, weighted):
        return made, weighted, None
    return made, weighted, (n / (2 * (n - p)), n / (2 * p)) if algo == "RF" else (1.0, (n - p) / p)


def fit(train: DataFrame, algo: str, params: ModelParams = ModelParams(),
        label: str = "label", names: list[str] | None = None, setup: str = "") -> Fitted:
    """Fit one model on a prepared frame (``features`` vector + label)."""
    made, weighted, by_class = _ready(train, algo, params, label)
    model = made.fit(weighted) if by_class is None else trees.fit_trees(made, weighted, by_class)
    return Fitted(setup, algo, model, list(names or []))


def fit_together(trains: Sequence[DataFrame], params: ModelParams = ModelParams(), label: str = "label") -> list:
    """Boosted models of several prepared frames. Those of many rows grow together,
    a job for each level of all; None for the others, which are left to :func:`fit`."""
    with ThreadPoolExecutor(max(1, len(trains))) as ex:
        ready = list(ex.map(lambda t: _ready(t, "GBT", params, label), trains))
    many = [i for i, (_, _, by_class) in enumerate(ready) if by_class is not None]
    made = trees.boost([ready[i] for i in many]) if many else []
    found = dict(zip(many, made, strict=True))
    return [found.get(i) for i in range(len(trains))]


def predict(f: Fitted, df: DataFrame, key: str = "customer_id", label: str = "label",
            also: Sequence[str] = ()) -> DataFrame:
    return positive_score(f.model.transform(df), key, label, also)


def feature_importance(spark, f: Fitted, top: int = 20) -> DataFrame:
    """M-6: tree importances with names, top 20."""
    imp = f.model.featureImportances.toArray().tolist()
    rows = [(n, float(v)) for n, v in zip(f.names, imp)]
    df = spark.createDataFrame(rows, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), F.col("feature").asc()).limit(top)


def coefficients(spark, f: Fitted, top: int = 20) -> DataFrame:
    """M-7: standardised coefficients, top 20 by |value| then value, with
    the direction of the effect."""
    coef = f.model.coefficients.toArray().tolist()
    df = spark.createDataFrame([(n, float(v)) for n, v in zip(f.names, coef)],
                               "feature string, coefficient double")
    df = df.withColumn("abs_coefficient", F.abs("coefficient")).withColumn(
        "direction", F.when(F.col("coefficient") > 0, "increases risk").otherwise("decreases risk"))
    return df.orderBy(F.col("abs_coefficient").desc(), F.col("coefficient").desc()).limit(top)


def best_model(evaluation: DataFrame, metric: str = "roc_auc") -> DataFrame:
    """M-10: best row by ``metric`` per setup (ties -> model name). The
    evaluation table has one row per (setup, model): a bounded table."""
    w = Window.partitionBy("setup").orderBy(F.col(metric).desc(), F.col("model").asc())
    return (evaluation.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
            .select("setup", "model", metric))
