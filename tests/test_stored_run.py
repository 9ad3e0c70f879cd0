"""Stages of a run are stored under what they were computed from."""

import datetime as dt
import time
from dataclasses import replace

import numpy as np
import pytest

from cadence.config import Fold, ModelParams, WindowSpec, TxMapping
from cadence.operators import models as M
from cadence.plans.pipeline import ModelRun, RunConfig, run_fingerprint

CFG = RunConfig(params=ModelParams(rf_trees=2, gbt_rounds=2), wf_rounds=2, mapping=TxMapping(
    "log", "who", "at", "kind", "paid", WindowSpec(obs_end=dt.date(2020, 10, 1), late_start=dt.date(2020, 7, 1),
                                                   pred_start=dt.date(2020, 10, 1), obs_periods=9, pred_periods=3, early_periods=6, late_periods=3)),
    folds=(Fold(1, dt.date(2020, 7, 1), dt.date(2020, 7, 1), dt.date(2020, 10, 1), 6.0, 3.0),), folds_start=dt.date(2020, 1, 1))


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("run"))
    rng = np.random.default_rng(3)
    spark.createDataFrame([(i, float(rng.normal()), int(i % 7), f"s{i % 3}") for i in range(240)],
                          "c_custkey long, c_acctbal double, c_nationkey int, c_mktsegment string").write.parquet(f"{d}/customer.parquet")
    rows = [(int(rng.integers(0, 240)), dt.date(2020, 1, 1) + dt.timedelta(days=int(rng.integers(0, 366))), "xy"[i % 2], float(i % 90))
            for i in range(3000)]
    spark.createDataFrame(rows, "who long, at date, kind string, paid double").write.parquet(f"{d}/log.parquet")
    return d


def test_stages_are_read_by_a_later_run(spark, tables, tmp_path, monkeypatch):
    def found(run):
        cells = [run.configuration("growth", "Tx-strict", algo) for algo in ("LR", "GBT")]
        return [sorted(map(tuple, df.collect())) for _, val, test in cells for df in (val, test)], len(cells[1][0].model.trees)

    want = found(ModelRun(spark, tables, CFG, str(tmp_path)))
    assert all(want[0]) and want[1] == 2

    def no_fit(*args, **kwargs):
        raise AssertionError("fitted again")

    monkeypatch.setattr(M, "fit", no_fit)
    again = ModelRun(spark, tables, CFG, str(tmp_path))
    assert found(again) == want


def test_an_unfinished_stage_is_computed_again(spark, tables, tmp_path):
    run = ModelRun(spark, tables, CFG, str(tmp_path))
    spark.range(3).write.parquet(f"{tmp_path}/types")  # left by a run that died before its marker
    assert run.types == ("x", "y") and run.types == ("x", "y")


def test_fingerprint_follows_inputs_and_parameters(spark, tables, tmp_path):
    own = run_fingerprint(spark, tables, CFG)
    assert own == run_fingerprint(spark, tables, replace(CFG, parallelism=1))
    assert own != run_fingerprint(spark, tables, replace(CFG, select_on="test"))
    other = str(tmp_path)
    spark.read.parquet(f"{tables}/customer.parquet").write.parquet(f"{other}/customer.parquet")
    log = spark.read.parquet(f"{tables}/log.parquet")
    log.repartition(3).write.parquet(f"{other}/log.parquet")
    assert own == run_fingerprint(spark, other, CFG)
    log.selectExpr("who", "at", "kind", "paid + 1 as paid").write.mode("overwrite").parquet(f"{other}/log.parquet")
    assert own != run_fingerprint(spark, other, CFG)


@pytest.mark.parametrize("features", ["subset", "full"])
def test_walk_forward_of_a_mapped_log(spark, tables, tmp_path, features):
    run = ModelRun(spark, tables, replace(CFG, fold_features=features), str(tmp_path))
    r = run.walk_forward().collect()
    assert [x["fold"] for x in r] == [1] and 0 <= r[0]["brier"] <= 1


def test_both_grids_fit_at_the_same_time_and_open_each_model_once(spark, tables, tmp_path, monkeypatch):
    began, ended, loads = {}, {}, []
    fit, cfg = M.fit, replace(CFG, params=ModelParams(rf_trees=2, gbt_rounds=3))

    def timed(train, algo, *args, **kwargs):
        key = (kwargs["setup"], algo, len(began))
        began[key] = time.monotonic()
        made = fit(train, algo, *args, **kwargs)
        ended[key] = time.monotonic()
        return made

    class Loader:
        def __init__(self, own):
            self.own = own

        def load(self, path):
            loads.append(path)
            return self.own.load(path)

    monkeypatch.setattr(M, "fit", timed)
    monkeypatch.setattr(M, "LOADERS", {a: Loader(own) for a, own in M.LOADERS.items()})
    run = ModelRun(spark, tables, cfg, str(tmp_path))
    assert run.scores().count() == 240
    assert len(began) == 12 and len(loads) == len(set(loads)) == 12
    boosted = [k for k in began if k[1] == "GBT"]
    assert len(boosted) == 4 and max(began[k] for k in boosted) < min(ended[k] for k in boosted)


def test_both_signals_are_calibrated_at_the_same_time(spark, tmp_path, monkeypatch):
    import threading

    from cadence.plans import pipeline as PL
    meet = threading.Barrier(2, timeout=30)

    class Fitted:
        def save(self, path):
            meet.wait()  # breaks if one waits for the other's end

    run = PL.ModelRun(spark, "unused", folder=str(tmp_path))
    monkeypatch.setattr(run, "both_grids", lambda: None)
    monkeypatch.setattr(run, "best", lambda which: (None, None, None))
    monkeypatch.setattr(PL, "_calib_input", lambda fitted, scored: None)
    monkeypatch.setattr(PL.C, "fit_isotonic", lambda frame, column: Fitted())
    monkeypatch.setattr(PL.C.IsotonicModel, "load", staticmethod(lambda s, path: path))
    risk, growth = run.calibrators()
    assert risk.endswith("calibrator-risk") and growth.endswith("calibrator-growth")
