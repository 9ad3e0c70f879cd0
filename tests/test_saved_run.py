"""A run that is saved and loaded scores as the run in memory."""

import os

import pytest

from cadence.config import ModelParams
from cadence.plans.pipeline import ModelRun, RunConfig, SavedRun, save_run

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")


def test_saved_run_scores_alike(spark, tmp_path):
    cfg = RunConfig(params=ModelParams(rf_trees=3, gbt_rounds=3), wf_rounds=2)
    run = ModelRun(spark, SF, cfg)
    save_run(run, str(tmp_path))
    saved = SavedRun(spark, str(tmp_path))
    assert saved.threshold() == run.threshold()
    n = run.base.count()
    assert saved.table("splits").count() == saved.table("features").count() == n
    assert saved.table("predictions_risk").select("setup", "model").distinct().count() == 9
    assert saved.table("run_summary").first()["n_customers"] == n
    want = {r["customer_id"]: r for r in run.scores().collect()}
    got = saved.score(saved.table("features")).collect()
    assert len(got) == len(want)
    for r in got:
        assert r["rr_raw"] == pytest.approx(want[r["customer_id"]]["rr_raw"])
        assert r["bp_raw"] == pytest.approx(want[r["customer_id"]]["bp_raw"])
