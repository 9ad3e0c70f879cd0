"""Chart data and walk-forward helpers against NumPy / hand counts."""

import datetime as dt

import numpy as np
import pytest

from cadence.config import Fold
from cadence.operators import report as R
from cadence.operators import walkforward as V


def test_histogram_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = np.round(rng.normal(size=400), 3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    h = {r["bin"]: (r["count"], r["density"]) for r in R.histogram(df, "x", 30).collect()}
    counts, edges = np.histogram(x, bins=30)
    dens, _ = np.histogram(x, bins=30, density=True)
    for b, (c, d) in h.items():
        assert c == counts[b] and d == pytest.approx(dens[b])
    assert sum(c for c, _ in h.values()) == 400


def test_constant_series_histogram(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    r = R.histogram(df, "x", 30).collect()
    assert len(r) == 1 and r[0]["bin_lo"] <= 5.0 <= r[0]["bin_hi"]


def test_clip_upper_and_marker_size(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "x double")
    clipped = [r["x"] for r in R.clip_upper(df, "x", 0.99).collect()]
    assert max(clipped) == pytest.approx(np.quantile(np.arange(1, 101), 0.99))
    sizes = [r["marker_size"] for r in R.marker_size(df, "x").collect()]
    assert min(sizes) == 2.0 and max(sizes) == 60.0


def test_fold_frame_month_and_day_grain_agree(spark):
    rows = [(1, dt.date(2020, m, d), "a" if d == 3 else "b", float(m * d)) for m in range(1, 13) for d in (3, 17)]
    rows += [(2, dt.date(2020, 2, 5), "a", 1.0)]
    tx = spark.createDataFrame(rows, "customer_id long, date date, type string, amount double")
    spine = spark.createDataFrame([(1,), (2,), (3,)], "customer_id long")
    month_folds = (Fold(1, dt.date(2020, 7, 1), dt.date(2020, 7, 1), dt.date(2020, 9, 1), 6.0, 2.0),)
    day_folds = (Fold(1, dt.date(2020, 7, 1), dt.date(2020, 7, 1), dt.date(2020, 8, 31), 6.0, 2.0),)
    assert V.period_grain(month_folds, dt.date(2020, 1, 1)) == "MM"
    assert V.period_grain(day_folds, dt.date(2020, 1, 1)) == "DD"
    a = {r["customer_id"]: r for r in V.fold_frame(spark, tx, spine, month_folds, dt.date(2020, 1, 1), ("a", "b")).collect()}
    assert a[1]["obs_count"] == 12 and a[1]["fut_count"] == 4 and a[1]["future_disengaged"] == 0
    assert a[2]["obs_count"] == 1 and a[2]["future_disengaged"] == 1
    assert a[3]["tx_count"] == 0 and a[3]["future_disengaged"] == 1
    amounts = [m * d for m in range(1, 7) for d in (3, 17)]
    assert a[1]["tx_std"] == pytest.approx(np.std(amounts, ddof=1))
    assert a[1]["tx_recency"] == (dt.date(2020, 6, 30) - dt.date(2020, 6, 17)).days
    assert a[1]["sh_a"] == 0.5


def test_null_is_not_clipped_to_the_top(spark):
    from cadence.functions.columns import clip01
    from cadence.operators.report import class_histograms, clip_upper, marker_size
    from cadence.operators.signals import strategic_segments
    df = spark.createDataFrame([(1.0, 0), (2.0, 1), (3.0, 0), (None, 1), (None, 0)], "x double, y int")
    got = sorted((r.x for r in clip_upper(df, "x").collect()), key=lambda v: (v is None, v or 0))
    assert got[3:] == [None, None] and got[2] < 3.0
    assert sum(r["count"] for r in class_histograms(df, ["x"], "y").collect()) == 3
    assert [r.marker_size is None for r in marker_size(df, "x").collect()].count(True) == 2
    assert df.select(clip01(df.x).alias("c")).where("c is null").count() == 2
    s = spark.createDataFrame([(1, 0.1, 5.0), (2, 0.1, 9.0), (3, 0.1, None)],
                              "customer_id long, redemption_risk double, expected_client_value double")
    assert {r.customer_id: r.segment for r in strategic_segments(s).collect()}[3] == "STABLE / LOW PRIORITY"


def test_nan_is_missing(spark):
    from cadence.operators.prep import fit_preprocessor
    from cadence.operators.quality import null_profile
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),), (None,)], "x double")
    p = fit_preprocessor(df, ["x"], {}, [])
    assert (p.medians["x"], p.means["x"]) == (2.0, 2.0)
    assert sorted(round(r.x, 6) for r in p.transform(df).collect()) == [-1.414214, 0.0, 0.0, 1.414214]
    assert null_profile(df).first().n_null == 2


def test_feature_groups_take_any_numeric_type(spark):
    from cadence.operators.features import infer_feature_groups
    df = spark.createDataFrame([], "customer_id long, a smallint, b decimal(9,2), c double, d string, e tinyint")
    assert infer_feature_groups(df, {}, ["d"])["numeric"] == ["a", "b", "c", "e"]


def test_leakage_and_booleans_leave(spark):
    from cadence.config import DROP_STRINGS, LEAKAGE_EXCLUDE
    from cadence.operators.quality import clean_customers
    names = [*LEAKAGE_EXCLUDE, *DROP_STRINGS]
    df = spark.createDataFrame([(1, True, *["x"] * len(names))],
                               "customer_id long, flag boolean, " + ", ".join(f"{n} string" for n in names))
    out = clean_customers(df)
    assert out.columns == ["customer_id", "flag"] and out.first().flag == 1


def test_a_cluster_needs_a_shared_checkpoint_folder():
    from types import SimpleNamespace

    import pytest

    from cadence.session import ensure_checkpoint_dir
    none = SimpleNamespace(get=lambda *a: None)
    sc = SimpleNamespace(getCheckpointDir=lambda: None, getConf=lambda: none, master="spark://host:7077")
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(SimpleNamespace(sparkContext=sc, conf=none))
