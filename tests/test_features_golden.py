"""Hand-made golden rows (FIXTURES section 3) for the features and labels."""

import datetime as dt

import pytest

from cadence.config import LabelRules, WindowSpec
from cadence.operators.features import customer_mart

W = WindowSpec(
    obs_start=dt.date(2023, 1, 1), obs_end=dt.date(2023, 10, 1), late_start=dt.date(2023, 7, 1),
    pred_start=dt.date(2023, 10, 1), pred_end=dt.date(2024, 1, 1),
    obs_periods=9.0, pred_periods=3.0, early_periods=6.0, late_periods=3.0)
TYPES = ("deposit", "payment")


def D(s):
    return dt.date.fromisoformat(s)


def mart(spark, rows, n_customers=1):
    tx = spark.createDataFrame(
        [(k, D(d), t, float(a) if a is not None else None) for k, d, t, a in rows],
        "customer_id long, date date, type string, amount double")
    spine = spark.createDataFrame([(i,) for i in range(n_customers)], "customer_id long")
    out = customer_mart(spine, tx, W, TYPES, LabelRules())
    return {r["customer_id"]: r.asDict() for r in out.collect()}


def test_one_event(spark):
    r = mart(spark, [(0, "2023-09-20", "deposit", 50.0)])[0]
    assert r["tx_count"] == 1 and r["tx_std"] == 0.0 and r["tx_span"] == 1
    assert r["tx_freq"] == 1.0 and r["tx_recency"] == 10 and r["tx_max_gap"] == 10
    assert r["tx_count_trend"] == 0.0 and r["tx_amt_trend"] == 0.0


def test_two_events_same_day(spark):
    r = mart(spark, [(0, "2023-03-01", "deposit", 1.0), (0, "2023-03-01", "payment", 2.0)])[0]
    assert r["tx_max_gap"] == 0 and r["tx_span"] == 1 and r["tx_freq"] == 2.0
    assert r["sh_deposit"] == 0.5 and r["sh_payment"] == 0.5


def test_skipped_months_trend(spark):
    rows = [(0, "2023-01-05", "deposit", 1.0)] + [(0, "2023-03-0%d" % i, "deposit", 1.0) for i in (1, 2)] + [
        (0, "2023-09-0%d" % i, "deposit", 1.0) for i in (1, 2, 3)]
    r = mart(spark, rows)[0]
    assert r["tx_count_trend"] == pytest.approx(1.0)


def test_weekend_ratio(spark):
    r = mart(spark, [(0, "2023-09-30", "deposit", 1.0), (0, "2023-09-25", "deposit", 1.0)])[0]
    assert r["tx_wknd_ratio"] == 0.5


@pytest.mark.parametrize("rows,expected", [
    ([(0, "2023-08-10", "deposit", 1.0)], 2.0),
    ([(0, "2023-02-10", "deposit", 1.0)], 0.0),
    ([(0, "2023-0%d-10" % m, "deposit", 1.0) for m in range(1, 7)]
     + [(0, "2023-0%d-10" % m, "deposit", 1.0) for m in range(7, 10)], 1.0),
])
def test_late_ratio(spark, rows, expected):
    assert mart(spark, rows)[0]["tx_late_ratio"] == pytest.approx(expected)


def test_small_amounts_cv(spark):
    r = mart(spark, [(0, "2023-05-01", "deposit", 0.25), (0, "2023-05-02", "deposit", 0.75)])[0]
    assert r["tx_mean"] == 0.5
    assert r["tx_cv"] == pytest.approx(r["tx_std"])


def _label_rows(k, n_obs, n_fut):
    rows = [(k, "2023-0%d-1%d" % (1 + i % 9, i % 10), "deposit", 1.0) for i in range(n_obs)]
    rows += [(k, "2023-1%d-1%d" % (i % 3, i % 10), "payment", 1.0) for i in range(n_fut)]
    return rows


@pytest.mark.parametrize("n_obs,n_fut,dis,growth", [
    (9, 0, 1, 0), (45, 3, 0, 0), (90, 5, 1, 0), (18, 9, 0, 1), (0, 0, 1, 1), (0, 2, 0, 1),
])
def test_labels(spark, n_obs, n_fut, dis, growth):
    r = mart(spark, _label_rows(0, n_obs, n_fut))[0]
    assert (r["obs_count"], r["fut_count"]) == (n_obs, n_fut)
    assert r["future_disengaged"] == dis and r["future_growth"] == growth
    if n_obs == 0 and n_fut > 0:
        assert r["activity_ratio"] == 1.0


def test_structural_zero_and_spine(spark):
    out = mart(spark, [(0, "2023-05-01", "deposit", 5.0)], n_customers=3)
    assert set(out) == {0, 1, 2}
    assert out[2]["tx_count"] == 0 and out[2]["tx_span"] == 0 and out[2]["tx_max_gap"] == 0


def test_null_amount_counts(spark):
    r = mart(spark, [(0, "2023-05-01", "deposit", None), (0, "2023-05-03", "deposit", 4.0)])[0]
    assert r["tx_count"] == 1 and r["obs_count"] == 2


def test_no_leakage_from_future_rows(spark):
    obs = [(0, "2023-0%d-1%d" % (1 + i % 9, i % 10), "deposit", float(i)) for i in range(30)]
    fut = [(0, "2023-11-05", "payment", 99.0), (0, "2023-12-05", "payment", 7.0)]
    a, b = mart(spark, obs + fut)[0], mart(spark, obs)[0]
    feats = [k for k in a if k.startswith("tx_") or k.startswith("sh_")]
    assert {k: a[k] for k in feats} == {k: b[k] for k in feats}


def test_median_of_every_customer(spark):
    """Hot, small and absent customers get pandas' median by the one path."""
    import numpy as np
    rng = np.random.default_rng(3)
    rows = [(0, "2023-0%d-1%d" % (1 + i % 9, i % 10), "deposit", float(np.round(rng.exponential(50), 2)))
            for i in range(40)]
    rows += [(1, "2023-02-11", "deposit", 3.0), (1, "2023-02-12", "payment", 8.0),
             (2, "2023-04-01", "deposit", 5.0)]
    out = mart(spark, rows, n_customers=4)
    for k in (0, 1, 2):
        vals = [a for kk, _, _, a in rows if kk == k]
        assert out[k]["tx_median"] == pytest.approx(float(np.median(vals)))
    assert out[3]["tx_median"] == 0.0


def test_windows_without_bounds_are_open(spark):
    import dataclasses
    rows = [(0, "2019-05-01", "deposit", 1.0), (0, "2023-11-05", "payment", 9.0), (0, "2031-01-01", "payment", 7.0)]
    tx = spark.createDataFrame([(k, D(d), t, a) for k, d, t, a in rows], "customer_id long, date date, type string, amount double")
    spine = spark.createDataFrame([(0,)], "customer_id long")
    whole = dataclasses.replace(W, obs_start=None, pred_end=None)
    r = customer_mart(spine, tx, whole, TYPES).first()
    assert (r["obs_count"], r["fut_count"]) == (1, 2)
    r = customer_mart(spine, tx, W, TYPES).first()
    assert (r["obs_count"], r["fut_count"]) == (0, 1)


def test_fold_std_of_large_amounts_does_not_cancel(spark):
    from cadence.config import Fold
    from cadence.operators.walkforward import fold_frame
    rows = [(0, "2023-01-05", "deposit", 1e9), (0, "2023-02-05", "deposit", 1e9 + 1), (0, "2023-02-06", "deposit", 1e9 + 2),
            (1, "2023-01-05", "deposit", None), (2, "2023-01-05", "payment", 5.0)]
    tx = spark.createDataFrame([(k, D(d), t, a) for k, d, t, a in rows], "customer_id long, date date, type string, amount double")
    spine = spark.createDataFrame([(0,), (1,), (2,)], "customer_id long")
    fold = Fold(1, D("2023-04-01"), D("2023-04-01"), D("2023-07-01"), 3.0, 3.0)
    out = {r["customer_id"]: r for r in fold_frame(spark, tx, spine, (fold,), D("2023-01-01"), TYPES).collect()}
    assert out[0]["tx_std"] == pytest.approx(1.0) and out[0]["tx_count"] == 3
    assert out[1]["tx_std"] == 0.0 and out[2]["tx_total"] == 5.0
