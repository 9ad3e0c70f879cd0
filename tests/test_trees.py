"""Trees grown on binned blocks of rows against MLlib's."""

import re

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cadence.config import ModelParams
from cadence.operators import models as M
from cadence.operators import trees as T


@pytest.fixture(scope="module")
def rows(spark, tmp_path_factory):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(4000, 6))
    x[:, 3] = np.round(x[:, 3])
    x[:, 5] = 7.0
    y = x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(size=4000) > 0.9
    names = [f"x{i}" for i in range(6)]
    df = spark.createDataFrame([(*map(float, a), float(b)) for a, b in zip(x, y, strict=True)], ", ".join(f"{c} double" for c in names) + ", label double")
    path = str(tmp_path_factory.mktemp("rows") / "rows")
    VectorAssembler(inputCols=names, outputCol="features").transform(df).select(
        "features", "label").repartition(3).write.parquet(path)
    return spark.read.parquet(path).coalesce(3)


def shape(model):
    """Splits and rounded predictions of all trees."""
    return re.sub(r"-?\d+\.\d+(E-?\d+)?", lambda m: f"{float(m[0]):.7g}", model.toDebugString).split("\n")[1:]


def both(rows, made, algo):
    _, weighted, _ = M._ready(rows, algo, ModelParams(), "label")
    n, p = rows.count(), rows.where("label = 1").count()
    by_class = (n / (2 * (n - p)), n / (2 * p)) if algo == "RF" else (1.0, (n - p) / p)
    return made.fit(weighted), T.fit_trees(made, weighted, by_class)


def scores(model, rows):
    from pyspark.ml.functions import vector_to_array
    return [r[0] for r in model.transform(rows).select(vector_to_array("probability")[1]).collect()]


def test_random_numbers_are_mllibs(spark):
    jvm = spark.sparkContext._jvm.org.apache.spark.util.random
    for seed in (42, -7, 1 << 40):
        own = jvm.XORShiftRandom(seed)
        want = [own.nextDouble() for _ in range(200)]
        assert T.uniforms(seed, 0, 200).tolist() == want and T.uniforms(seed, 67, 50).tolist() == want[67:117]
    assert T.uniforms(1, 5, 0).tolist() == []
    random = spark.sparkContext._jvm.java.util.Random(5)
    own = T._JavaRandom(5)
    assert [own.long() for _ in range(5)] == [random.nextLong() for _ in range(5)]


def test_boosted_trees_equal_mllibs(rows, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 700)  # several blocks of a task
    monkeypatch.setattr(T, "LINEAGE", 3)
    made = M.estimator("GBT", ModelParams(gbt_rounds=8), 1.0).setMinInstancesPerNode(40)
    want, got = both(rows, made, "GBT")
    assert len(shape(want)) > 100 and shape(got) == shape(want) and got.treeWeights == want.treeWeights
    assert scores(got, rows) == pytest.approx(scores(want, rows), abs=1e-9)
    assert got.featureImportances.toArray() == pytest.approx(want.featureImportances.toArray(), abs=1e-9)
    assert {p.name: v for p, v in got._paramMap.items()} == {p.name: v for p, v in want._paramMap.items()}


def test_stored_nodes_equal_mllibs(spark, rows, tmp_path):
    made = M.estimator("GBT", ModelParams(gbt_rounds=2), 1.0).setMinInstancesPerNode(40)
    nodes = []
    for i, model in enumerate(both(rows, made, "GBT")):
        model.save(f"{tmp_path}/{i}")
        nodes.append([r["nodeData"] for r in spark.read.parquet(f"{tmp_path}/{i}/data").orderBy("treeID", "nodeData.id").collect()])
    for want, got in zip(*nodes, strict=True):
        assert [got[k] for k in ("id", "rawCount", "leftChild", "rightChild")] == [want[k] for k in ("id", "rawCount", "leftChild", "rightChild")]
        for k in ("prediction", "impurityStats", "gain"):
            assert got[k] == pytest.approx(want[k], abs=1e-7)
        if want["impurity"] >= 0:  # MLlib has -1 for leaves without a valid split
            assert got["impurity"] == pytest.approx(want["impurity"], abs=1e-7)


@pytest.mark.parametrize("n, subset", [(1, "sqrt"), (3, "all")])
def test_forests_without_draws_equal_mllibs(rows, n, subset):
    made = M.estimator("RF", ModelParams(rf_trees=n), 1.0).setBootstrap(False).setFeatureSubsetStrategy(subset)
    want, got = both(rows, made, "RF")
    assert len(shape(want)) > 50 and shape(got) == shape(want)
    assert scores(got, rows) == pytest.approx(scores(want, rows), abs=1e-9)


def test_forests_draw_as_mllib_does(rows):
    want, got = both(rows, M.estimator("RF", ModelParams(rf_trees=60), 1.0), "RF")
    assert got.getNumTrees == 60 and 0.9 < got.totalNumNodes / want.totalNumNodes < 1.1
    assert np.corrcoef(scores(got, rows), scores(want, rows))[0, 1] > 0.98
    drawn = T._drawn(1.0, 42, 0, 0, 0, 200_000)
    assert drawn.mean() == pytest.approx(1.0, abs=0.02) and drawn.var() == pytest.approx(1.0, abs=0.03)
    assert (T._drawn(1.0, 42, 0, 0, 0, 100) != T._drawn(1.0, 42, 1, 0, 0, 100)).any()


def test_many_rows_are_grown_together_in_the_jobs_of_one(rows, monkeypatch):
    monkeypatch.setattr(M, "BINNED_ROWS", 1000)
    jobs, own = [], T._total
    monkeypatch.setattr(T, "_total", lambda rdd: (jobs.append(1), own(rdd))[1])
    params = ModelParams(gbt_rounds=3)
    other = rows.withColumn("label", 1 - F.col("label"))
    alone = [M.fit(df, "GBT", params).model for df in (rows, other)]
    each, jobs[:] = len(jobs) // 2, []
    together = M.fit_together([rows, rows.limit(500), other], params)
    assert len(jobs) == each == 3 * params.gbt_depth + 1
    assert together[1] is None and [shape(m) for m in (together[0], together[2])] == [shape(m) for m in alone]


def test_rows_of_one_class_or_nominal_features_are_left_to_mllib(rows, monkeypatch):
    monkeypatch.setattr(M, "BINNED_ROWS", 10)
    assert M._ready(rows.where("label = 1"), "GBT", ModelParams(), "label")[2] is None
    assert M._ready(rows, "LR", ModelParams(), "label")[2] is None
    nominal = rows.withMetadata("features", {"ml_attr": {"attrs": {"nominal": [{"idx": 0, "vals": ["a", "b"]}]}, "num_attrs": 6}})
    assert M._ready(nominal, "RF", ModelParams(), "label")[2] is None
