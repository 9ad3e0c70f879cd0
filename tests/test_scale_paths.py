"""Paths that only large or awkward inputs take, against brute force."""

import datetime as dt
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from cadence.config import Fold, SplitSpec, WindowSpec
from cadence.functions import ordered
from cadence.operators import evaluate as E
from cadence.operators import features as X
from cadence.operators import ranking as RK
from cadence.operators import report as R
from cadence.operators import split as S
from cadence.operators import walkforward as V

W = WindowSpec(obs_end=dt.date(2021, 1, 1), late_start=dt.date(2020, 9, 1), pred_start=dt.date(2021, 1, 1),
               obs_periods=12.0, pred_periods=3.0, early_periods=8.0, late_periods=4.0)


def log(spark, n_hot=3000, seed=1):
    """A hot customer (many zeros), small ones, and rows after the window."""
    rng = np.random.default_rng(seed)
    rows = []
    for c, n in [(1, n_hot), (2, 1024), (3, 1025), (4, 7), (5, 8), (6, 1)]:
        amounts = np.where(rng.random(n) < 0.4, 0.0, np.round(rng.lognormal(4, 2, n), 2))
        days = rng.integers(0, 420, n)
        rows += [(c, dt.date(2020, 1, 1) + dt.timedelta(days=int(d)), "ab"[i % 2], float(a))
                 for i, (d, a) in enumerate(zip(days, amounts, strict=True))]
    rows += [(4, dt.date(2020, 3, 1), None, None), (7, dt.date(2020, 3, 1), "a", None)]
    pdf = pd.DataFrame(rows, columns=["customer_id", "date", "type", "amount"])
    tx = spark.createDataFrame(rows, "customer_id long, date date, type string, amount double").repartition(5)
    return tx, pdf[pdf.date < W.obs_end]


@pytest.mark.parametrize("held", [1 << 16, 50])
def test_exact_medians_of_large_customers(spark, monkeypatch, held):
    monkeypatch.setattr(ordered, "GROUP_VALUES", held)  # 50: the brackets are narrowed over several rounds
    tx, obs = log(spark)
    spine = spark.range(1, 9).withColumnRenamed("id", "customer_id")
    got = {r["customer_id"]: r for r in X.customer_mart(spine, tx, W, ("a", "b")).collect()}
    for c, own in obs.groupby("customer_id"):
        a = own.amount.dropna()
        assert got[c]["tx_median"] == pytest.approx(a.median() if len(a) else 0.0), c
        assert got[c]["tx_std"] == pytest.approx(a.std() if len(a) > 1 else 0.0)
        assert got[c]["tx_count"] == len(a) and got[c]["obs_count"] == len(own)
    assert got[8]["tx_count"] == 0 and got[7]["tx_median"] == 0.0


def test_grouped_median_by_several_keys(spark, monkeypatch):
    monkeypatch.setattr(ordered, "GROUP_VALUES", 64)
    rng = np.random.default_rng(2)
    pdf = pd.DataFrame({"g": rng.integers(0, 2, 9000), "k": np.where(rng.random(9000) < 0.8, "hot", "cold"),
                        "v": np.round(rng.exponential(3, 9000), 1)})
    got = {(r["g"], r["k"]): r["median"] for r in ordered.grouped_median(spark.createDataFrame(pdf), ["g", "k"], "v").collect()}
    assert got == pytest.approx(pdf.groupby(["g", "k"])["v"].median().to_dict())


def test_mart_plan_has_one_scan_and_no_global_sort(spark, tmp_path):
    tx, _ = log(spark, 50)
    tx.write.parquet(f"{tmp_path}/tx")
    spine = spark.range(1, 9).withColumnRenamed("id", "customer_id")
    mart = X.customer_mart(spine, spark.read.parquet(f"{tmp_path}/tx"), W, ("a", "b"), heaviest=50)
    plan = mart._sc._jvm.PythonSQLUtils.explainString(mart._jdf.queryExecution(), "simple")
    assert plan.count("FileScan") == 1 and "rangepartitioning" not in plan and "ExistingRDD" not in plan


def test_types_that_share_a_name(spark):
    types = ("A b", "a_b", "日本", "中国", "x")
    assert list(X.share_names(types).values()) == ["sh_a_b", "sh_a_b_2", "sh___", "sh____2", "sh_x"]
    rows = [(1, dt.date(2020, 2, 1), t, 1.0) for t in types] + [(1, dt.date(2020, 3, 1), "中国", 1.0)]
    tx = spark.createDataFrame(rows, "customer_id long, date date, type string, amount double")
    spine = spark.createDataFrame([(1,)], "customer_id long")
    r = X.customer_mart(spine, tx, W, types, heaviest=9).first()
    assert [r[n] for n in X.share_names(types).values()] == pytest.approx([1 / 6, 1 / 6, 1 / 6, 2 / 6, 1 / 6])
    folds = (Fold(1, dt.date(2020, 7, 1), dt.date(2020, 7, 1), dt.date(2020, 9, 1), 6.0, 2.0),)
    for frame in (V.fold_frame, V.full_fold_frame):
        r = frame(spark, tx, spine, folds, dt.date(2020, 1, 1), types).first()
        assert r["sh____2"] == pytest.approx(2 / 6) and r["sh_a_b_2"] == pytest.approx(1 / 6)


def test_types_are_those_of_the_window_and_limited(spark, tmp_path, monkeypatch):
    from dataclasses import replace

    from cadence.config import ORDERS_MAPPING
    from cadence.sources import log_profile, log_types, tables
    rows = [(1, dt.date(1999, 1, 1), "b", 1.0), (1, dt.date(1999, 1, 2), "a", None), (2, dt.date(1999, 1, 2), None, 2.0),
            (1, dt.date(2000, 5, 1), "later", 1.0)]
    spark.createDataFrame(rows, "c long, d date, t string, a double").write.parquet(f"{tmp_path}/log.parquet")
    m = replace(ORDERS_MAPPING, table="log", customer_id="c", date="d", type="t", amount="a")
    assert log_types(spark, str(tmp_path), m) == ("a", "b")
    types, heaviest = log_profile(spark, str(tmp_path), m)
    assert types == ("a", "b") and heaviest >= 1
    assert log_types(spark, str(tmp_path), m, dt.date(2001, 1, 1)) == ("a", "b", "later")
    monkeypatch.setattr(tables, "MAX_TYPES", 1)
    for f in (log_types, log_profile):
        with pytest.raises(ValueError, match="types"):
            f(spark, str(tmp_path), m)


def test_quantiles_bring_few_values_to_the_driver(spark, monkeypatch):
    monkeypatch.setattr(ordered, "BRACKET_VALUES", 100)
    rng = np.random.default_rng(5)
    half = np.concatenate((np.zeros(10_000), rng.random(10_000)))
    data = {"edge": half, "most": np.where(rng.random(20_000) < 0.97, 0.0, rng.random(20_000)), "tied": np.repeat([1.0, 2.0], 10_000),
            "wide": rng.normal(size=20_000)}
    df = spark.createDataFrame(pd.DataFrame(data)).repartition(4)
    seen = []
    collect = type(df).collect

    def counted(self):
        rows = collect(self)
        seen.append(sum(len(v) if isinstance(v, list) else 1 for r in rows for v in r))
        return rows

    monkeypatch.setattr(type(df), "collect", counted)
    probs = [0.08, 0.499, 0.5, 0.501, 0.98]
    got = ordered.order_statistics(df, list(data), probs)
    for c, v in data.items():
        for p in probs:
            assert got[c, p].value() == pytest.approx(np.quantile(v, p)), (c, p)
    targets = len(data) * len(probs)
    assert seen and max(seen) <= targets * (ordered._GRID + 8) + len(data) * (3 + 2 * len(probs))


def test_curves_have_a_point_at_every_distinct_score(spark):
    rng = np.random.default_rng(9)
    score = np.concatenate((np.linspace(2, 3, 200), np.round(rng.random(3000), 3), np.linspace(-2, -1, 200)))
    label = np.concatenate((np.ones(200), (rng.random(3000) < 0.4), np.zeros(200))).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"score": score, "label": label})).repartition(6)
    by = pd.DataFrame({"score": score, "label": label}).groupby("score")["label"].agg(["sum", "count"]).sort_index(ascending=False)
    tp, fp = by["sum"].cumsum(), (by["count"] - by["sum"]).cumsum()
    roc = {r["threshold"]: (r["fpr"], r["tpr"]) for r in E.roc_points(df).collect()}
    pr = {r["threshold"]: (r["recall"], r["precision"]) for r in E.pr_points(df).collect()}
    assert roc.pop(None) == (0.0, 0.0) and pr.pop(None) == (0.0, 1.0)
    assert set(roc) == set(pr) == set(by.index)
    assert [roc[t] for t in by.index] == [pytest.approx(p) for p in zip(fp / fp.iloc[-1], tp / tp.iloc[-1], strict=True)]
    assert [pr[t] for t in by.index] == [pytest.approx(p) for p in zip(tp / tp.iloc[-1], tp / (tp + fp), strict=True)]


def test_running_totals_know_the_next_row(spark):
    df = spark.createDataFrame([(i, float(i * i % 7)) for i in range(100)], "k long, v double").repartition(7)
    got = ordered.running_totals(df, [F.col("k").asc()], ["v"], next_cols=["v"]).orderBy("k").collect()
    v = [float(i * i % 7) for i in range(100)]
    assert [r["next_v"] for r in got] == [*v[1:], None] and [r["cum_v"] for r in got] == np.cumsum(v).tolist()


def test_histograms_of_all_columns_equal_numpy(spark, monkeypatch):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"a": rng.exponential(2, 900), "b": np.round(rng.normal(size=900), 2), "y": rng.integers(0, 2, 900)})
    df = spark.createDataFrame(pdf)
    got = R.class_histograms(df, ["a", "b"], "y", 20, 0.99).collect()
    for c in ("a", "b"):
        cut = np.quantile(pdf[c], 0.99)
        for y in (0, 1):
            v = np.minimum(pdf[c][pdf.y == y], cut)
            counts, edges = np.histogram(v, bins=20)
            own = {r["bin"]: r for r in got if r["feature"] == c and r["series"] == str(y)}
            assert {b: r["count"] for b, r in own.items()} == {b: n for b, n in enumerate(counts) if n}
            assert own[0]["bin_lo"] == pytest.approx(edges[0]) and own[19]["bin_hi"] == pytest.approx(edges[-1])
    monkeypatch.setattr(R, "MAX_SERIES", 1)
    with pytest.raises(ValueError, match="series"):
        R.histogram(df, "a", 20, "y")
    assert R.histograms(df.limit(0), ["a"], 20, clip_q=0.99).count() == 0


@pytest.mark.parametrize("mask", [0xFFFFFFFF, 0x3])
def test_exact_split_without_a_sort(spark, monkeypatch, mask):
    """The cut of each class, also when almost all hashes tie."""
    import hashlib
    full = S._hash32
    monkeypatch.setattr(S, "_hash32", lambda key, seed: full(key, seed).bitwiseAND(F.lit(mask)))
    rows = [(i, None if i % 50 == 0 else i % 3) for i in range(700)] + [(9000, 7)]
    df = spark.createDataFrame(rows, "customer_id long, y int").repartition(4)
    out = S.assign_split(df, SplitSpec(), label="y", method="exact")
    got = {r["customer_id"]: r["split"] for r in out.collect()}
    h = {i: int(hashlib.md5(f"42:{i}".encode()).hexdigest()[:8], 16) & mask for i, _ in rows}
    for y in {y for _, y in rows}:
        own = sorted((i for i, c in rows if c == y), key=lambda i: (h[i], i))
        want = ["train" if k / len(own) < 0.6 else "val" if k / len(own) < 0.8 else "test" for k in range(len(own))]
        assert [got[i] for i in own] == want, y
    assert S.assign_split(df.limit(0), SplitSpec(), label="y", method="exact").count() == 0


def test_full_fold_equals_the_mart_of_its_window(spark):
    tx, _ = log(spark, 1500)
    start = dt.date(2020, 1, 1)
    spine = spark.range(1, 9).withColumnRenamed("id", "customer_id")
    folds = (Fold(1, dt.date(2020, 7, 1), dt.date(2020, 7, 1), dt.date(2020, 9, 1), 6.0, 2.0),
             Fold(2, dt.date(2020, 10, 1), dt.date(2020, 10, 1), dt.date(2020, 12, 1), 9.0, 2.0))
    got = {(r["fold"], r["customer_id"]): r for r in V.full_fold_frame(spark, tx, spine, folds, start, ("a", "b")).collect()}
    assert len(got) == 16
    for f in folds:
        w = WindowSpec(obs_end=f.obs_end, late_start=f.obs_end - (f.obs_end - start) // 3, pred_start=f.pred_start, pred_end=f.pred_end,
                       obs_periods=f.obs_periods, pred_periods=2.0, early_periods=f.obs_periods * 2 / 3, late_periods=f.obs_periods / 3)
        for r in X.customer_mart(spine, tx, w, ("a", "b")).collect():
            own = got[f.fold, r["customer_id"]]
            for c in ("obs_count", "fut_count", "future_disengaged", *X.tx_feature_columns(("a", "b"))):
                assert own[c] == pytest.approx(r[c]), (f.fold, r["customer_id"], c)


def test_drilldown_filters_both_inputs_by_the_key(spark, tmp_path):
    sig = spark.range(20).select(F.col("id").alias("customer_id"), *[F.lit(0.5).alias(c) for c in RK.SIGNAL_COLS[1:]])
    mart = spark.range(20).select(F.col("id").alias("customer_id"), F.lit(120.4).alias("tx_total"))
    for name, df in (("s", sig), ("m", mart)):
        df.write.parquet(f"{tmp_path}/{name}")
    sig, mart = (spark.read.parquet(f"{tmp_path}/{n}") for n in "sm")
    one = RK.client_drilldown(sig, mart, "7")
    plan = one._sc._jvm.PythonSQLUtils.explainString(one._jdf.queryExecution(), "simple")
    assert plan.count("EqualTo(customer_id,7)") == 2
    assert [(r["client_id"], r["behaviour"][0]["value"]) for r in one.collect()] == [("7", "120")]
    assert RK.client_drilldown(sig, mart, "seven").count() == RK.client_drilldown(sig, mart, "007").count() == 0


def test_source_profile_counts_all_columns(spark, tmp_path):
    from cadence.config import ORDERS_MAPPING
    from cadence.sources import source_profile
    spark.range(3).selectExpr("id as c_custkey", "1 as x").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(1, dt.date(2020, 1, 1), 2, 3, 4)], "o_custkey long, o_orderdate date, a int, b int, c int").write.parquet(
        f"{tmp_path}/orders.parquet")
    got = Counter(tuple(r) for r in source_profile(spark, str(tmp_path), ORDERS_MAPPING).collect())
    day = dt.date(2020, 1, 1)
    assert got == {("orders", 1, 5, day, day): 1, ("customer", 3, 2, None, None): 1}
