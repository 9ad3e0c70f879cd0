"""Per-row feature attribution (M-8), re-aimed from a single-machine explainer.

* Linear model: closed form ``coef_j * (x_j - mean_j)`` with the background
  mean of the training rows (MLlib ``Summarizer``) - pure column expressions.
* Tree ensembles: path-dependent Shapley values. The nodes of the fitted trees
  are read as a table from the saved model; every leaf becomes a product of one
  condition per feature, whose Shapley values have a closed form by a
  polynomial. Arrow batches of rows are explained in ``mapInPandas`` against
  the broadcast leaves.

Every row handed in is explained.
"""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cadence.session import ensure_checkpoint_dir

TOP = 20
#: Features on a leaf's path up to which all patterns of its conditions are a table.
MAX_BITS = 10


def linear_attribution(model, background: DataFrame, rows: DataFrame, names: list[str],
                       key: str = "customer_id") -> DataFrame:
    """Long format (key, feature, contribution) for a logistic model."""
    mean = background.select(Summarizer.mean(F.col("features")).alias("m")).first()["m"].toArray()
    coef = model.coefficients.toArray()
    x = vector_to_array("features")
    contrib = F.transform(x, lambda v, i: F.element_at(F.array(*[F.lit(float(c)) for c in coef]), i + 1)
                          * (v - F.element_at(F.array(*[F.lit(float(m)) for m in mean]), i + 1)))
    arr = rows.select(key, contrib.alias("c"))
    return _long(arr, names, key)


def _long(arr: DataFrame, names: list[str], key: str) -> DataFrame:
    nm = F.array(*[F.lit(n) for n in names])
    return arr.select(key, F.explode(F.arrays_zip(nm.alias("feature"), F.col("c").alias("contribution")))
                      .alias("z")).select(key, "z.feature", "z.contribution")


def node_table(model, spark: SparkSession) -> DataFrame:
    """The nodes of a fitted tree ensemble as a table: ``tree, node, feature,
    threshold, left, right, cover`` (weight of the training rows that reached
    the node), ``value`` and the tree's ``weight``. Read from the saved model.
    Values are margins (boosted trees) or probabilities of class 1 (forests);
    the trees' weighted values add up to those of the model."""
    path = f"{ensure_checkpoint_dir(spark)}/trees-{uuid.uuid4().hex}"
    model.write().save(path)
    boosted = isinstance(model, GBTClassificationModel)
    stats = F.col("nodeData.impurityStats")
    total = F.aggregate(stats, F.lit(0.0), lambda x, y: x + y)
    value = F.col("nodeData.prediction") if boosted else F.when(total > 0, stats[1] / total).otherwise(0.0)
    weights = [float(w) for w in model.treeWeights]
    if not boosted:
        weights = [w / sum(weights) for w in weights]
    per_tree = spark.createDataFrame(list(enumerate(weights)), "treeID int, weight double")
    split = F.col("nodeData.split")
    return spark.read.parquet(f"{path}/data").join(F.broadcast(per_tree), "treeID").select(
        F.col("treeID").alias("tree"), F.col("nodeData.id").alias("node"), split["featureIndex"].alias("feature"),
        split["numCategories"].alias("categories"),
        F.get(split["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), (stats[0] if boosted else total).alias("cover"),
        value.alias("value"), "weight")


@dataclass
class Leaf:
    """A leaf with the conditions of its path, one a feature: ``low < x <=
    high``, met by the share ``met`` of the training rows on the way."""

    value: float
    features: np.ndarray
    low: np.ndarray
    high: np.ndarray
    met: np.ndarray


def leaves(nodes: list[Row]) -> list[Leaf]:
    """All leaves of a node table; a value is the leaf's times its tree's weight."""
    at = {(r["tree"], r["node"]): r for r in nodes}
    if any(r["left"] >= 0 and r["categories"] >= 0 for r in nodes):
        raise ValueError("categorical splits are not explained")
    found = []
    pending = [(r, {}) for (_, node), r in sorted(at.items()) if node == 0]
    while pending:
        r, path = pending.pop()
        if r["left"] < 0:
            own = sorted(path)
            low, high, met = (np.array([path[f][i] for f in own], float) for i in range(3))
            found.append(Leaf(r["value"] * r["weight"], np.array(own, int), low, high, met))
            continue
        f, cut = r["feature"], r["threshold"]
        low, high, met = path.get(f, (-np.inf, np.inf, 1.0))
        for child, bounds in ((r["left"], (low, min(high, cut))), (r["right"], (max(low, cut), high))):
            c = at[r["tree"], child]
            share = c["cover"] / r["cover"] if r["cover"] else 0.0
            pending.append((c, path | {f: (*bounds, met * share)}))
    return found


def leaf_shapley(leaf: Leaf, met: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf's features for patterns ``met`` (a row per
    pattern, a column per feature: whether the condition holds).

    A coalition sees the leaf's value times, for each feature, whether its
    condition holds (known features) or the share of training rows that met it
    (others). The sum over coalitions of each size is a coefficient of the
    product of ``share + holds * t`` over the other features, so the cost is
    polynomial in the number of features on the path."""
    m = len(leaf.features)
    weight = np.array([math.factorial(s) * math.factorial(m - 1 - s) / math.factorial(m) for s in range(m)])
    out = np.empty(met.shape)
    for j in range(m):
        poly = np.zeros((len(met), m))
        poly[:, 0] = 1.0
        for k in range(m):
            if k != j:
                grown = poly * leaf.met[k]
                grown[:, 1:] += poly[:, :-1] * met[:, k:k + 1]
                poly = grown
        out[:, j] = leaf.value * (met[:, j] - leaf.met[j]) * (poly @ weight)
    return out


def shapley_values(trees: list[Leaf], x: np.ndarray) -> tuple[np.ndarray, float]:
    """Path-dependent Shapley values of the rows ``x`` and the mean value that
    they start from."""
    out = np.zeros(x.shape)
    for leaf in trees:
        if not len(leaf.features):
            continue
        own = x[:, leaf.features]
        holds = ~(own <= leaf.low) & ((own <= leaf.high) | np.isinf(leaf.high))  # a NaN goes right, as in the model
        # few patterns occur; each is solved once
        bit = np.arange(len(leaf.features))
        pattern = holds @ (1 << bit)
        if len(bit) <= MAX_BITS:  # marked in a table of all patterns, so no row is sorted
            codes = np.flatnonzero(np.bincount(pattern, minlength=1 << len(bit)))
            solved = np.zeros((1 << len(bit), len(bit)))
            solved[codes] = leaf_shapley(leaf, (codes[:, None] >> bit & 1).astype(float))
            out[:, leaf.features] += solved[pattern]
        else:
            codes, which = np.unique(pattern, return_inverse=True)
            out[:, leaf.features] += leaf_shapley(leaf, (codes[:, None] >> bit & 1).astype(float))[which]
    return out, float(sum(leaf.value * leaf.met.prod() for leaf in trees))


def tree_attribution(model, rows: DataFrame, names: list[str], key: str = "customer_id") -> DataFrame:
    """Long format (key, feature, contribution) plus a ``_bias_`` row per key:
    path-dependent Shapley values, which add up to the model's margin (boosted
    trees) or probability (forests). The leaves of the fitted trees are
    broadcast; their number is bounded by the model's parameters."""
    spark = rows.sparkSession
    sent = spark.sparkContext.broadcast(leaves(node_table(model, spark).collect()))
    nf = len(names)
    src = rows.select(key, vector_to_array("features").alias("x"))

    def run(batches):
        for pdf in batches:
            x = np.vstack(pdf["x"].to_numpy()) if len(pdf) else np.zeros((0, nf))
            contrib, bias = shapley_values(sent.value, x)
            yield pd.DataFrame({key: pdf[key].to_numpy(), "c": list(np.column_stack((contrib, np.full(len(x), bias))))})

    kind = rows.schema[key].dataType.simpleString()
    # the bias is one more element, so that every row is explained once
    return _long(src.mapInPandas(run, f"{key} {kind}, c array<double>"), [*names, "_bias_"], key)


def attribution_summary(long: DataFrame, top: int = TOP) -> DataFrame:
    """Mean |contribution| per feature, top 20."""
    return (long.where(F.col("feature") != "_bias_").groupBy("feature")
            .agg(F.avg(F.abs("contribution")).alias("mean_abs_contribution"))
            .orderBy(F.col("mean_abs_contribution").desc(), F.col("feature").asc()).limit(top))


def top_feature_values(long: DataFrame, summary: DataFrame, k: int = 5) -> DataFrame:
    """Per-row contributions of the k most important features."""
    topk = summary.limit(k).select("feature")
    return long.join(F.broadcast(topk), "feature")
