"""A run on other tables from the command line."""

import datetime as dt
import json
import os

import pytest

from cadence.__main__ import arguments, configuration, main
from cadence.config import ORDERS_MAPPING
from cadence.plans.settings import run_config

SF = "/root/testdata/sf0.001"

EVENTS = {
    "mapping": {"table": "events", "customer_id": "user_id", "date": "ts", "type": "event_type", "amount": "value",
                "windows": {"obs_end": "2024-01-22", "late_start": "2024-01-15", "pred_start": "2024-01-22", "obs_periods": 3,
                            "pred_periods": 1, "early_periods": 2, "late_periods": 1}},
    "customers": {"table": "customer", "customer_id": "c_custkey", "columns": {"balance": "c_acctbal", "segment": "c_mktsegment"},
                  "ordinal": {}},
    "folds_start": "2024-01-01", "fold_features": "full", "wf_rounds": 2, "params": {"rf_trees": 2, "gbt_rounds": 2},
    "folds": [{"fold": 1, "obs_end": "2024-01-15", "pred_start": "2024-01-15", "pred_end": "2024-01-22", "obs_periods": 2,
               "pred_periods": 1}],
}


def test_json_becomes_a_configuration(tmp_path):
    cfg = run_config(json.dumps(EVENTS))
    assert cfg.mapping.windows.obs_end == dt.date(2024, 1, 22) and cfg.folds[0].pred_end == dt.date(2024, 1, 22)
    assert cfg.params.gbt_rounds == 2 and cfg.params.gbt_depth == 4 and cfg.customers.columns["balance"] == "c_acctbal"
    path = tmp_path / "run.json"
    path.write_text(json.dumps(EVENTS))
    assert configuration(arguments(["--data", "d", "--out", "o", "--config", str(path), "--select-on", "test"])).select_on == "test"
    assert configuration(arguments(["--data", "d", "--out", "o"])).mapping == ORDERS_MAPPING


@pytest.mark.parametrize("bad", [{"mappings": {}}, {"mapping": {"table": "x", "colour": 1}}, [], {"mapping": EVENTS["mapping"]},
                                 {"folds": [{"fold": 1, "obs_stop": "2024-01-01"}]}])
def test_mistakes_are_named(bad):
    with pytest.raises(ValueError):
        run_config(json.dumps(bad))


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_an_events_run_from_the_command_line(spark, tmp_path, capsys, monkeypatch):
    """Of the tables, only those that need no grid of models (``test_saved_run`` writes all)."""
    import cadence.__main__ as cli
    from cadence.sources import save_result

    def few_tables(run, out):
        return {n: save_result(df, f"{out}/{n}") for n, df in (("walk_forward", run.walk_forward()), ("features", run.base))}

    monkeypatch.setattr(cli, "save_run", few_tables)
    (tmp_path / "run.json").write_text(json.dumps(EVENTS))
    main(["--data", SF, "--out", str(tmp_path / "out"), "--config", str(tmp_path / "run.json")])
    paths = json.loads(capsys.readouterr().out)
    folds = spark.read.parquet(paths["walk_forward"]).collect()
    assert [r["fold"] for r in folds] == [1]
    customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert spark.read.parquet(paths["features"]).count() == customers
