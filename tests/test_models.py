"""MLlib models on a planted-signal frame (the driver's data has no signal)."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from cadence.config import ModelParams
from cadence.operators import evaluate as E
from cadence.operators import models as M


@pytest.fixture(scope="module")
def planted(spark):
    rng = np.random.default_rng(7)
    n = 600
    x1, x2 = rng.normal(size=n), rng.normal(size=n)
    y = (x1 + 0.3 * rng.normal(size=n) > 0.8).astype(int)
    rows = [(i, float(a), float(b), int(c), "train" if i % 5 < 3 else "test") for i, (a, b, c) in enumerate(zip(x1, x2, y))]
    df = spark.createDataFrame(rows, "customer_id long, x1 double, x2 double, label int, split string")
    return VectorAssembler(inputCols=["x1", "x2"], outputCol="features").transform(
        df.withColumn("label", F.col("label").cast("double")))


def test_class_weights(spark):
    df = spark.createDataFrame([(1,), (0,), (0,), (0,)], "y int")
    w = sorted((r["y"], r["w_balanced"], r["w_pos"]) for r in M.class_weights(df, "y").collect())
    assert w[0] == (0, 4 / 6, 1.0) and w[-1] == (1, 2.0, 3.0)


@pytest.mark.parametrize("algo", ["LR", "RF", "GBT"])
def test_models_learn_planted_signal(spark, planted, algo):
    params = ModelParams(rf_trees=20, gbt_rounds=20)
    f = M.fit(planted.where(F.col("split") == "train"), algo, params, names=["x1", "x2"])
    auc = E.rank_metrics(M.predict(f, planted.where(F.col("split") == "test"))).first()["roc_auc"]
    assert auc > 0.9
    if algo == "LR":
        top = M.coefficients(spark, f).first()
        assert top["feature"] == "x1" and top["direction"] == "increases risk"
    else:
        assert M.feature_importance(spark, f).first()["feature"] == "x1"


@pytest.mark.parametrize("algo", ["GBT", "RF"])
def test_tree_attribution_is_additive(spark, planted, algo):
    from pyspark.ml.functions import vector_to_array
    from cadence.operators import attribution as A
    params = ModelParams(rf_trees=10, gbt_rounds=10)
    f = M.fit(planted.where(F.col("split") == "train"), algo, params, names=["x1", "x2"])
    rows = planted.where(F.col("split") == "test")
    long = A.tree_attribution(f.model, rows, ["x1", "x2"])
    total = {r["customer_id"]: r["s"] for r in long.groupBy("customer_id").agg(F.sum("contribution").alias("s")).collect()}
    col = "rawPrediction" if algo == "GBT" else "probability"
    ref = {r["customer_id"]: r["v"] for r in f.model.transform(rows).select(
        "customer_id", vector_to_array(col)[1].alias("v")).collect()}
    assert len(total) == rows.count()
    for k, v in ref.items():
        assert total[k] == pytest.approx(v, abs=1e-9)
    assert A.attribution_summary(long).first()["feature"] == "x1"


def test_linear_attribution(spark, planted):
    from pyspark.ml.functions import vector_to_array
    from cadence.operators import attribution as A
    train = planted.where(F.col("split") == "train")
    f = M.fit(train, "LR", ModelParams(), names=["x1", "x2"])
    rows = planted.where(F.col("split") == "test")
    long = A.linear_attribution(f.model, train, rows, ["x1", "x2"])
    mean = train.select(vector_to_array("features").alias("a")).select(
        F.avg(F.col("a")[0]).alias("m0"), F.avg(F.col("a")[1]).alias("m1")).first()
    base = f.model.intercept + f.model.coefficients[0] * mean["m0"] + f.model.coefficients[1] * mean["m1"]
    total = {r["customer_id"]: r["s"] for r in long.groupBy("customer_id").agg(F.sum("contribution").alias("s")).collect()}
    for r in f.model.transform(rows).select("customer_id", vector_to_array("rawPrediction")[1].alias("m")).collect():
        assert total[r["customer_id"]] + base == pytest.approx(r["m"], abs=1e-9)


def brute_shapley(nodes, x, n_features):
    """All coalitions: the expected value of the trees when only the features of the coalition are known."""
    from itertools import combinations
    from math import factorial
    at = {(r["tree"], r["node"]): r for r in nodes}

    def value(r, known):
        if r["left"] < 0:
            return r["value"]
        left, right = at[r["tree"], r["left"]], at[r["tree"], r["right"]]
        if r["feature"] in known:
            return value(left if x[r["feature"]] <= r["threshold"] else right, known)
        return (left["cover"] * value(left, known) + right["cover"] * value(right, known)) / r["cover"]

    def total(known):
        return sum(r["weight"] * value(r, known) for (_, n), r in at.items() if n == 0)

    out = []
    for j in range(n_features):
        others = [f for f in range(n_features) if f != j]
        out.append(sum(factorial(k) * factorial(n_features - 1 - k) / factorial(n_features) * (total({*c, j}) - total(set(c)))
                       for k in range(n_features) for c in combinations(others, k)))
    return out, total(set())


@pytest.mark.parametrize("algo", ["GBT", "RF"])
def test_tree_attribution_equals_brute_force_shapley(spark, algo):
    from cadence.operators import attribution as A
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(300, 4)), 1)
    y = ((x[:, 0] * x[:, 1] > 0) ^ (x[:, 2] > 0.8)).astype(float)
    df = spark.createDataFrame([(i, *map(float, r), float(c)) for i, (r, c) in enumerate(zip(x, y, strict=True))],
                               "customer_id long, a double, b double, c double, d double, label double")
    df = VectorAssembler(inputCols=list("abcd"), outputCol="features").transform(df)
    f = M.fit(df, algo, ModelParams(rf_trees=6, rf_depth=6, rf_min_leaf=2, gbt_rounds=5, gbt_subsample=1.0, gbt_colsample=1.0),
              names=list("abcd"))
    nodes = A.node_table(f.model, spark).collect()
    assert max(r["feature"] for r in nodes) >= 2
    got = {}
    for r in A.tree_attribution(f.model, df.where("customer_id < 25"), list("abcd")).collect():
        got.setdefault(r["customer_id"], {})[r["feature"]] = r["contribution"]
    for i in range(25):
        want, base = brute_shapley(nodes, x[i], 4)
        assert [got[i][n] for n in "abcd"] == pytest.approx(want, abs=1e-9)
        assert got[i]["_bias_"] == pytest.approx(base, abs=1e-9)


def test_shapley_of_missing_values_and_single_leaves():
    from cadence.operators import attribution as A
    leaf = A.Leaf(2.0, np.array([0]), np.array([-np.inf]), np.array([1.0]), np.array([0.25]))
    other = A.Leaf(6.0, np.array([0]), np.array([1.0]), np.array([np.inf]), np.array([0.75]))
    alone = A.Leaf(3.0, np.array([], int), np.array([]), np.array([]), np.array([]))
    phi, base = A.shapley_values([leaf, other, alone], np.array([[0.5], [2.0], [np.nan]]))
    assert base == 8.0
    assert phi[:, 0].tolist() == [-3.0, 1.0, 1.0]


def test_a_fit_has_no_more_tasks_than_cores_or_work(spark):
    df = spark.range(3000).repartition(64)
    assert M.dealt(df, 3000).rdd.getNumPartitions() == 1
    wide = M.dealt(df, 10**9)
    assert wide.rdd.getNumPartitions() == M.dealt(df, 3000, 10**6).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert wide.count() == wide.distinct().count() == 3000


def test_fits_are_given_dealt_rows(spark, planted, monkeypatch):
    seen = []
    make = M.estimator

    def noted(algo, *args):
        made = make(algo, *args)
        own = type(made).fit
        monkeypatch.setattr(type(made), "fit", lambda self, df: (seen.append((df.rdd.getNumPartitions(), df.count())), own(self, df))[1])
        return made

    monkeypatch.setattr(M, "estimator", noted)
    M.fit(planted.repartition(64), "GBT", ModelParams(gbt_rounds=2))
    assert seen == [(1, 600)]


def test_tree_attribution_explains_every_row_once(spark, planted):
    from cadence.operators import attribution as A
    f = M.fit(planted, "GBT", ModelParams(gbt_rounds=2))
    long = A.tree_attribution(f.model, planted, ["x1", "x2"])
    assert long._jdf.queryExecution().executedPlan().toString().count("MapInPandas") == 1
    assert long.count() == 3 * 600 and long.where("feature = '_bias_'").select("contribution").distinct().count() == 1


def test_patterns_by_table_equal_patterns_by_sorting(monkeypatch):
    from cadence.operators import attribution as A
    rng = np.random.default_rng(5)
    trees = [A.Leaf(float(rng.normal()), np.array([0, 2, 3]), np.array([-np.inf, -0.5, 0.0]), np.array([0.3, np.inf, 0.9]), rng.random(3))
             for _ in range(4)] + [A.Leaf(1.0, np.array([1]), np.array([0.1]), np.array([np.inf]), np.array([0.4]))]
    x = rng.normal(size=(200, 4))
    x[::7, 2] = np.nan
    by_table = A.shapley_values(trees, x)
    monkeypatch.setattr(A, "MAX_BITS", 0)
    by_sorting = A.shapley_values(trees, x)
    assert np.array_equal(by_table[0], by_sorting[0]) and by_table[1] == by_sorting[1]
    assert A.shapley_values(trees, x[:0])[0].shape == (0, 4)


def test_boosted_fits_hold_more_rows_a_task_than_linear_ones(spark, planted, monkeypatch):
    seen = {}
    for algo in ("LR", "GBT"):
        own = type(M.estimator(algo, ModelParams(), 1.0)).fit
        monkeypatch.setattr(type(M.estimator(algo, ModelParams(), 1.0)), "fit",
                            lambda self, df, own=own, algo=algo: (seen.update({algo: df.rdd.getNumPartitions()}), own(self, df))[1])
    rows = planted.select("features", "label").crossJoin(spark.range(60).select()).repartition(16)  # 36,000 rows
    for algo in ("LR", "GBT"):
        M.fit(rows, algo, ModelParams(gbt_rounds=1))
    assert seen == {"LR": 2, "GBT": 1}
    assert M.dealt(rows, 10**9, rows=M.BOOSTED_ROWS).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_forests_keep_their_nodes_and_their_trees(planted):
    params = ModelParams(rf_trees=7, rf_min_leaf=2)
    weighted = M.class_weights(planted, "label")
    made = M.estimator("RF", params, 1.0)
    assert made.getCacheNodeIds()
    kept, walked = (e.fit(weighted).toDebugString.split("\n")[1:] for e in (made, made.copy({made.cacheNodeIds: False})))
    assert len(kept) > 50 and kept == walked


def test_forests_leave_cores_to_the_boosted_models_beside_them(spark, planted, monkeypatch):
    seen = []
    forest = type(M.estimator("RF", ModelParams(), 1.0))
    own = forest.fit
    monkeypatch.setattr(forest, "fit", lambda self, df: (seen.append((df.rdd.getNumPartitions(), df.count())), own(self, df))[1])
    cores = spark.sparkContext.defaultParallelism
    rows = planted.select("features", "label").crossJoin(spark.range(60).select()).repartition(2 * cores)
    M.fit(rows, "RF", ModelParams(rf_trees=40, rf_depth=2))
    assert seen == [(min(72, cores - min(M.SPARED, cores // 2)), 36_000)]
    for n, asked in ((M.TASK_ROWS, cores), (M.BOOSTED_ROWS * cores, cores)):  # few rows, or enough for all cores
        assert M.dealt(rows, n, 300, spared=M.SPARED).rdd.getNumPartitions() == asked
