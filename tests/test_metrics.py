"""Golden and property tests for the score-table metrics and sweeps."""

import numpy as np
import pytest

from cadence.functions.ordered import exact_quantiles, running_totals
from cadence.operators import calibrate as C
from cadence.operators import evaluate as E
from pyspark.sql import functions as F


def scored(spark, scores, labels):
    return spark.createDataFrame([(i, int(y), float(s)) for i, (s, y) in enumerate(zip(scores, labels))],
                                 "customer_id long, label int, score double")


def test_auc_ap_with_ties(spark):
    df = scored(spark, [.9, .8, .8, .4, .3, .1], [1, 0, 1, 0, 1, 0])
    r = E.rank_metrics(df).first()
    assert r["roc_auc"] == pytest.approx(0.7222, abs=1e-4)
    assert r["pr_auc"] == pytest.approx(0.7556, abs=1e-4)


def test_auc_invariant_under_monotone_transform(spark):
    rng = np.random.default_rng(0)
    s = rng.random(500)
    y = (rng.random(500) < s).astype(int)
    a = E.rank_metrics(scored(spark, s, y)).first()["roc_auc"]
    b = E.rank_metrics(scored(spark, np.round(s ** 3, 2) * 0 + s ** 3, y)).first()["roc_auc"]
    assert a == pytest.approx(b)


def test_grouped_rank_metrics_match_ungrouped(spark):
    rng = np.random.default_rng(1)
    rows = [(g, i, int(rng.random() < 0.3), float(np.round(rng.random(), 2))) for g in (1, 2) for i in range(200)]
    df = spark.createDataFrame(rows, "fold int, customer_id long, label int, score double")
    grouped = {r["fold"]: r["roc_auc"] for r in E.rank_metrics(df, by=["fold"]).collect()}
    for g in (1, 2):
        single = E.rank_metrics(df.where(F.col("fold") == g)).first()["roc_auc"]
        assert grouped[g] == pytest.approx(single)


def test_sweep_recall_non_increasing_and_best_first(spark):
    rng = np.random.default_rng(2)
    s = np.round(rng.random(300), 3)
    y = (rng.random(300) < s).astype(int)
    sw = E.threshold_sweep(scored(spark, s, y)).orderBy("threshold").collect()
    assert len(sw) == 91
    rec = [r["recall"] for r in sw]
    assert all(a >= b for a, b in zip(rec, rec[1:]))
    best = E.best_threshold(E.threshold_sweep(scored(spark, s, y))).first()
    top = max(r["f1"] for r in sw)
    assert best["f1"] == top
    assert best["threshold"] == min(r["threshold"] for r in sw if r["f1"] == top)


def test_threshold_equal_score_is_positive(spark):
    r = E.threshold_metrics(scored(spark, [0.5, 0.2], [1, 0]), 0.5).first()
    assert r["recall"] == 1.0 and r["precision"] == 1.0


def test_top_decile_tie_break(spark):
    df = scored(spark, [0.5] * 20, [1] + [0] * 19)
    r = E.top_decile(df).first()
    assert r["k"] == 2 and r["precision_at_k"] == 0.5


def test_reliability_bin_edge(spark):
    df = scored(spark, [0.1, 0.1000001, 1.0], [0, 1, 1])
    bins = {r["bin"]: r["n"] for r in C.reliability_curve(df).collect()}
    assert bins == {0: 1, 1: 1, 9: 1}


def test_running_totals_match_cumsum(spark):
    rng = np.random.default_rng(3)
    v = rng.integers(0, 10, 1000)
    df = spark.createDataFrame([(i, int(x)) for i, x in enumerate(v)], "k long, v long").repartition(7)
    out = running_totals(df, [F.col("k").asc()], ["v"]).orderBy("k").collect()
    assert [r["cum_v"] for r in out] == list(np.cumsum(v))
    assert [r["row_no"] for r in out] == list(range(1, 1001))


def test_exact_quantiles_match_numpy(spark):
    rng = np.random.default_rng(4)
    a, b = rng.normal(size=501), rng.exponential(size=64)
    rows = [(float(x), float(b[i]) if i < len(b) else None) for i, x in enumerate(a)]
    df = spark.createDataFrame(rows, "a double, b double")
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, ["a", "b"], [0.08, 0.5, 0.99]).collect()}
    for c, arr in (("a", a), ("b", b)):
        for p in (0.08, 0.5, 0.99):
            assert got[(c, p)] == pytest.approx(np.quantile(arr, p))


def test_isotonic_calibration_monotone_and_not_worse(spark):
    rng = np.random.default_rng(5)
    s = rng.random(400)
    y = (rng.random(400) < s ** 2).astype(int)
    df = scored(spark, s, y)
    m = C.fit_isotonic(df)
    out = C.apply_isotonic(m, df).orderBy("score").collect()
    cal = [r["calibrated"] for r in out]
    assert all(a <= b + 1e-12 for a, b in zip(cal, cal[1:]))
    b0 = E.brier(df).first()["brier"]
    b1 = E.brier(C.apply_isotonic(m, df), score="calibrated").first()["brier"]
    assert b1 <= b0


def test_grouped_median_matches_pandas_with_hot_key(spark):
    import pandas as pd
    from cadence.functions.ordered import grouped_median
    rng = np.random.default_rng(6)
    keys = np.concatenate([np.zeros(3000, dtype=int), rng.integers(1, 200, 6000)])
    vals = np.round(rng.exponential(100, len(keys)), 2)
    pdf = pd.DataFrame({"k": keys, "v": vals})
    df = spark.createDataFrame(pdf).repartition(6)
    got = {r["k"]: r["median"] for r in grouped_median(df, ["k"], "v").collect()}
    exp = pdf.groupby("k")["v"].median().to_dict()
    assert set(got) == set(exp)
    for k, v in exp.items():
        assert got[k] == pytest.approx(v)


def test_exact_quantiles_of_skewed_tied_and_infinite_values(spark, monkeypatch):
    from cadence.functions import ordered
    monkeypatch.setattr(ordered, "BRACKET_VALUES", 20)
    rng = np.random.default_rng(8)
    a = np.round(rng.lognormal(3, 2, 3000), 2)
    a[7] = np.inf
    cols = {"a": a, "b": np.repeat([1.0, 2.0, 7.5], 1000), "c": np.where(rng.random(3000) < 0.9, 0.0, rng.random(3000))}
    df = spark.createDataFrame(list(zip(*[v.tolist() for v in cols.values()])), "a double, b double, c double")
    probs = [0.0, 0.08, 0.5, 0.92, 0.99, 1.0]
    got = {(r["column"], r["prob"]): r["value"] for r in exact_quantiles(df, list(cols), probs).collect()}
    for c, v in cols.items():
        for p in probs:
            want = v.max() if p == 1.0 else np.quantile(v, p)  # NumPy subtracts infinities
            assert got[(c, p)] == pytest.approx(want), (c, p)


def test_metrics_on_empty_input(spark):
    df = spark.createDataFrame([], "customer_id long, label int, score double")
    r = E.top_decile(df).first()
    assert r["precision_at_k"] == 0.0 and r["lift_top_decile"] == 0.0
    m = E.rank_metrics(df).collect()
    assert m == [] or m[0]["roc_auc"] is None


def test_evaluation_table_matches_single_runs(spark):
    a = scored(spark, [0.9, 0.5, 0.5, 0.5, 0.1] * 6, [1, 0, 1, 0, 0] * 6)
    b = scored(spark, [0.2, 0.2, 0.8], [0, 1, 1])
    none = a.limit(0)
    t = {r["model"]: r for r in E.evaluation_table({("s", "a"): a, ("s", "b"): b, ("s", "none"): none}).collect()}
    for name, df in (("a", a), ("b", b)):
        rank, top, brier = E.rank_metrics(df).first(), E.top_decile(df).first(), E.brier(df).first()
        assert t[name]["roc_auc"] == pytest.approx(rank["roc_auc"])
        assert t[name]["pr_auc"] == pytest.approx(rank["pr_auc"])
        assert t[name]["precision_at_k"] == pytest.approx(top["precision_at_k"])
        assert t[name]["brier"] == pytest.approx(brier["brier"])
    assert t["none"]["roc_auc"] is None and t["none"]["precision_at_k"] == 0.0


def test_string_keys_and_ties(spark):
    df = spark.createDataFrame([(f"C{i:02d}", int(i < 2), 0.5) for i in range(20)], "customer_id string, label int, score double")
    assert E.top_decile(df).first()["precision_at_k"] == 1.0


def mllib_isotonic(df):
    from pyspark.ml.regression import IsotonicRegression
    pts = df.groupBy(F.col("score").alias("x")).agg(F.avg(F.col("label").cast("double")).alias("y"),
                                                    F.count(F.lit(1)).cast("double").alias("w"))
    m = IsotonicRegression(featuresCol="x", labelCol="y", weightCol="w").fit(pts)
    return m.boundaries.toArray(), m.predictions.toArray()


@pytest.mark.parametrize("kind", ["ties", "distinct", "falling", "separated"])
def test_isotonic_over_ranges_equals_mllib(spark, kind):
    rng = np.random.default_rng(12)
    x = rng.random(4000)
    y = (rng.random(4000) < x).astype(int)
    if kind == "ties":
        x = np.round(x, 2)
    if kind == "falling":
        y = 1 - y
    if kind == "separated":
        y = (x > 0.5).astype(int)
    df = spark.createDataFrame(list(zip(x.tolist(), y.tolist(), strict=True)), "score double, label int")
    at, value = C.fit_isotonic(df, range_points=150).knots()  # many ranges, several rounds
    b, p = mllib_isotonic(df)
    grid = np.concatenate((x, np.linspace(-0.2, 1.2, 500)))
    assert np.interp(grid, at, value) == pytest.approx(np.interp(grid, b, p), abs=1e-12)


def test_isotonic_of_a_million_scores(spark):
    df = spark.range(1_000_000).select(((F.col("id") * 7919 % 1_000_003) / 1_000_003).alias("score"),
                                       (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000 < (F.col("id") * 7919 % 1_000_003) / 1_000_003)
                                       .cast("int").alias("label"))
    at, value = C.fit_isotonic(df).knots()
    b, p = mllib_isotonic(df)
    grid = np.linspace(0, 1, 20_000)
    assert np.interp(grid, at, value) == pytest.approx(np.interp(grid, b, p), abs=1e-9)
    assert len(at) < 5000


def test_isotonic_edge_rows(spark):
    df = spark.createDataFrame([(None, 1), (float("nan"), 1), (0.5, None), (0.2, 0), (0.8, 1)], "score double, label int")
    m = C.fit_isotonic(df)
    assert m.knots()[0].tolist() == [0.2, 0.8]
    got = [r["calibrated"] for r in C.apply_isotonic(m, df.orderBy("score")).collect()]
    assert sum(x is None for x in got) >= 1
    empty = C.fit_isotonic(df.limit(0))
    assert all(r["calibrated"] is None for r in C.apply_isotonic(empty, df).collect())
