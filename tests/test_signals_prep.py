"""Signals, split, preprocessing and quality operators on tiny frames."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.config import SplitSpec
from cadence.operators import prep as P
from cadence.operators import quality as Q
from cadence.operators import signals as G
from cadence.operators import split as S


def test_minmax_constant_column_is_zero(spark):
    df = spark.createDataFrame([(1, 4.0), (2, 4.0), (3, 4.0)], "customer_id long, x double")
    assert [r["x"] for r in G.minmax_scale(df, ["x"]).collect()] == [0.0, 0.0, 0.0]


def test_minmax_range(spark):
    df = spark.createDataFrame([(1, 2.0), (2, 4.0), (3, 6.0)], "customer_id long, x double")
    got = sorted(r["x"] for r in G.minmax_scale(df, ["x"]).collect())
    assert got == [0.0, 0.5, 1.0]


def test_action_order(spark):
    df = spark.createDataFrame([(0.7, 0.2), (0.7, 0.7), (0.5, 0.5), (0.6, 0.3)], "bp double, rr double")
    got = [r[0] for r in df.select(G.action(F.col("bp"), F.col("rr"))).collect()]
    assert got == ["Upsell", "Retention", "Monitor", "Monitor"]


def test_signal_table_ranges(spark):
    rng = np.random.default_rng(0)
    rows = [(i, float(rng.random()), float(rng.random()), float(rng.random() * 100), float(rng.random()),
             int(rng.integers(0, 50)), int(rng.integers(0, 90)), float(rng.normal()), float(rng.random() * 3))
            for i in range(200)]
    df = spark.createDataFrame(rows, "customer_id long, bp_raw double, rr_raw double, tx_total double, "
                                     "tx_freq double, tx_recency int, tx_max_gap int, tx_count_trend double, "
                                     "tx_late_ratio double")
    sig = G.signal_table(df).collect()
    assert len(sig) == 200
    for c in ("buy_propensity", "redemption_risk", "engagement_score", "master_signal", "co_additive",
              "opportunity_frontier_score"):
        vals = [r[c] for r in sig]
        assert min(vals) == pytest.approx(0.0) and max(vals) == pytest.approx(1.0)


def test_hash_split_disjoint_complete(spark):
    df = spark.range(2000).withColumnRenamed("id", "customer_id")
    s = S.assign_split(df, SplitSpec())
    counts = {r["split"]: r["count"] for r in s.groupBy("split").count().collect()}
    assert sum(counts.values()) == 2000 and set(counts) == {"train", "val", "test"}
    assert 0.55 < counts["train"] / 2000 < 0.65


def test_exact_split_proportions(spark):
    df = spark.range(1000).select(F.col("id").alias("customer_id"), (F.col("id") % 10 == 0).cast("int").alias("y"))
    s = S.assign_split(df, SplitSpec(), label="y", method="exact")
    got = {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}
    assert got[(1, "train")] == 60 and got[(1, "val")] == 20 and got[(1, "test")] == 20
    assert got[(0, "train")] == 540 and got[(0, "val")] == 180 and got[(0, "test")] == 180


def test_preprocessor(spark):
    train = spark.createDataFrame(
        [(1.0, 5.0, "Low", "b"), (3.0, 5.0, "High", "a"), (None, 5.0, None, "b")],
        "x double, c double, ordv string, nom string")
    pre = P.fit_preprocessor(train, ["x", "c"], {"ordv": ["Low", "Medium", "High"]}, ["nom"])
    assert pre.medians["x"] == 2.0 and pre.scales["c"] == 1.0 and pre.modes["nom"] == "b"
    assert pre.output_names == ["x", "c", "ordv", "nom_b"]
    test = spark.createDataFrame([(None, 7.0, "Unknown", "z")], "x double, c double, ordv string, nom string")
    r = pre.transform(test).first()
    assert r["x"] == pytest.approx(0.0) and r["c"] == 2.0 and r["ordv"] == -1.0 and r["nom_b"] == 0.0


def test_quality(spark):
    cust = spark.createDataFrame([(1, True, None), (2, False, "x"), (2, True, "y")],
                                 "customer_id long, flag boolean, location string")
    tx = spark.createDataFrame([(1,), (3,)], "customer_id long")
    kp = Q.key_profile(cust, tx).first()
    assert (kp["n_cust_unique"], kp["n_tx_unique"], kp["n_duplicated"]) == (2, 2, 1)
    oc = Q.orphan_counts(cust, tx).first()
    assert (oc["orphans_cust_to_tx"], oc["orphans_tx_to_cust"]) == (1, 1)
    nulls = {r["column_name"]: (r["n_null"], r["pct"]) for r in Q.null_profile(cust).collect()}
    assert nulls == {"location": (1, 33.3)}
    clean = Q.clean_customers(cust)
    assert clean.columns == ["customer_id", "flag"] and dict(clean.dtypes)["flag"] == "int"
    with pytest.raises(ValueError):
        Q.assert_unique(cust)


def test_sink_roundtrip_and_missing_path(spark, tmp_path):
    from cadence.sources import load_result, save_result
    df = spark.createDataFrame([(1, 0.5), (2, 0.25)], "customer_id long, score double")
    path = save_result(df, str(tmp_path / "t"))
    assert sorted(r["customer_id"] for r in load_result(spark, path).collect()) == [1, 2]
    with pytest.raises(FileNotFoundError):
        load_result(spark, str(tmp_path / "missing"))
